"""The registered queries of the corpus operators and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .bpe import encode_and_decode
from .common import fresh_dir, table
from .decontaminate import contaminated
from .html_extract import extract_pages
from . import language_id
from .lm import held_out, score, train
from .near_duplicates import near_duplicates
from . import secrets
from .sharding import shard_documents
from .spelling import spelling_variants
from .url_filters import ALLOW, BLOCK, match_urls
from .warc import ROW_ID, read_warc, write_warc
from .whitening import whiten

QUERIES: dict = {}
ORACLES: dict = {}

#: The rules of the url query: host, path, verdict.
URL_RULES = [
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by ``URL_RULES``; urls that no rule fits are allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return match_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


QUERIES["op1_url_filters"] = op1_url_filters
ORACLES["op1_url_filters"] = """
with rules(host, path, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest as (select page_id, row_number() over () as id,
  case when coalesce(instr(url, '://'), 0) > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, id,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
hits as (select p.id, r.host || r.path as rule, r.verdict,
  row_number() over (partition by p.id order by length(r.host || r.path) desc, length(r.host) desc) as k
  from parts p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') as verdict
from parts p left join hits h on h.id = p.id and h.k = 1
"""


def vocabulary_path() -> str:
    """The public byte-level BPE vocabulary of the token query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_and_decode(docs, vocabulary_path()).drop("text")


QUERIES["op7_bpe"] = op7_bpe


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, with a gapless slot in the shard."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs, shards=24)


QUERIES["op9_sharding"] = op9_sharding


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES["op3_html_extraction"] = op3_html_extraction


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back: responses with their payloads, revisits by their headers alone."""
    path = fresh_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.substring_index(c, ROW_ID, -1).try_cast("long")  # noqa: E731  # null for a page without an id
    columns = "record_id string, record_type string, refers_to string, payload_digest string, payload_length bigint"
    full = read_warc(spark, path, "record_id string, record_type string, payload binary").where("record_type = 'response'")
    again = read_warc(spark, path, columns).where("record_type = 'revisit'")
    return full.select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        again.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", number("refers_to").alias("refers_to"))
    )


QUERIES["op8_warc"] = op8_warc
ORACLES["op8_warc"] = """
with p as (select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages),
k as (select body, max(page_id) as keeper, count(*) as rows from p where n >= 1000 group by body)
select p.page_id, p.n as payload_bytes, sha1(p.body) as payload_digest,
  case when k.rows > 1 and p.page_id <> k.keeper then 'revisit' else 'response' end as record_type,
  case when k.rows > 1 and p.page_id <> k.keeper then k.keeper end as refers_to
from p left join k on k.body = p.body
"""


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a bigram model of the documents whose crc32(doc_id) mod 10 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"), 10, 0))
    return score(docs, train(docs.where(~F.col("held_out")))).drop("text")


QUERIES["op2_lm_scoring"] = op2_lm_scoring


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    field = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), field).drop("text")


QUERIES["op10_language_id"] = op10_language_id


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other vectors of each vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES["op4_nearest"] = op4_nearest


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates and the number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op6_jaccard_join"] = op6_jaccard_join


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of a document and a benchmark item that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op5_decontamination"] = op5_decontamination


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts of the base kinds, the digest of their spans, and all spans."""
    return secrets.summary(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))


QUERIES["op11_secret_scan"] = op11_secret_scan


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector projected on the 32 leading components, over their deviations."""
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES["op12_whitening"] = op12_whitening


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, the form it is a variant of, and the last form of that chain."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op13_spelling_variants"] = op13_spelling_variants
# The checksum is made bit by bit from its polynomial; words one edit apart meet on what is left when a letter is cut out.
ORACLES["op13_spelling_variants"] = """
with recursive crc_table as (select list(c order by i) as t from (
  select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))),
runs as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents),
lowered as (select coalesce(doc_id::varchar, '') || ':' || translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as named,
  translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low, count(*) as n from runs where length(run) >= 6 group by all),
coded as (select low, n, hex(encode(named)) as h from lowered),
summed as (select low, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::bigint)),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) as crc from coded, crc_table),
spoiled as (select case when crc % 199 = 0 then substr(low, 1, crc % length(low)) || substr(low, crc % length(low) + 2) else low end as word, n from summed),
words as (select word, sum(n)::bigint as n from spoiled where length(word) >= 6 group by word having sum(n) >= 5),
cut as (select word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as k from words)),
near as (select a.word, b.word as other, b.n from cut a join cut b on a.k = b.k and a.rest = b.rest and a.word <> b.word
  union select c.word, w.word, w.n from cut c join words w on w.word = c.rest
  union select w.word, c.word, c.n from cut c join words w on w.word = c.rest),
best as (select word, count(*) as n_near, arg_min(other, (-n, other)) as form, max(n) as form_n from near group by word),
forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * w.n then form end as form, case when form_n >= 5 * w.n then form_n end as form_n from words w left join best b using (word)),
chain as (select word, word as place, 0 as k from forms union all select c.word, f.form, c.k + 1 from chain c join forms f on f.word = c.place where f.form is not null),
ends as (select word, arg_max(place, k) as root from chain group by word)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n from forms f join ends e using (word)
"""
