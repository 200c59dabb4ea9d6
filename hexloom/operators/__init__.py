"""DataFrame-in, DataFrame-out operators of the hex and authority tables."""
