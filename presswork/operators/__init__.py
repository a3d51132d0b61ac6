from presswork.operators.articles import (
    dedup_articles,
    keep_scorable,
    prepare_articles,
    select_base,
)
from presswork.operators.joins import count_joined, join_results
from presswork.operators.matching import hot_keys, join_unique, last_replies, match_scores
from presswork.operators.scorers import HttpReady, HttpScorer, Scorer, ScorerFactory
from presswork.operators.scoring import (
    CATEGORY,
    CHUNK_SIZE,
    EMPTY_TEXT,
    SENTIMENT,
    ScoreSpec,
    Tally,
    score,
    score_all,
    score_table,
)
from presswork.operators.stats import batch_stats, error_rows, stat_columns

__all__ = [
    "CATEGORY",
    "CHUNK_SIZE",
    "EMPTY_TEXT",
    "HttpReady",
    "HttpScorer",
    "SENTIMENT",
    "ScoreSpec",
    "Scorer",
    "ScorerFactory",
    "Tally",
    "batch_stats",
    "count_joined",
    "dedup_articles",
    "error_rows",
    "hot_keys",
    "join_results",
    "join_unique",
    "keep_scorable",
    "last_replies",
    "match_scores",
    "prepare_articles",
    "score",
    "score_all",
    "score_table",
    "select_base",
    "stat_columns",
]
