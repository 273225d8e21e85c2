from reelframe.plans.charts import popularity_chart, runtime_chart
from reelframe.plans.jobs import (
    genre_histogram,
    keyword_top100,
    load_job,
    popularity_job,
    popularity_top10,
    runtime_job,
    score_inputs,
    score_job,
    scrub_job,
)

__all__ = [
    "genre_histogram",
    "keyword_top100",
    "load_job",
    "popularity_chart",
    "popularity_job",
    "popularity_top10",
    "runtime_chart",
    "runtime_job",
    "score_inputs",
    "score_job",
    "scrub_job",
]
