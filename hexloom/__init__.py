"""hexloom: hex geography, authority tables and corpus operators as PySpark jobs."""
