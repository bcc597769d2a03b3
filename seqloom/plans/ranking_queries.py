"""Negative sampling, scoring, ranking metrics and recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import ranking, recommend, sampling, sequences
from seqloom.operators.recommend import SCORE_DIGITS
from seqloom.plans.bindings import RATING_ORDER, VECTOR_DIM, Tables
from seqloom.plans.registry import as_text, query

TOP_K = 10


def _eval_samples(t: Tables) -> DataFrame:
    samples = sequences.training_samples(t.vector_events, RATING_ORDER, max_train_per_user=0)
    items = t.read("embeddings").agg(F.count_distinct("vec_id").alias("n")).scalar()
    return sampling.negative_candidates(samples.where("split <> 'train'"), items)


def _candidate_rows(t: Tables) -> DataFrame:
    return _eval_samples(t).select("user_id", "split", F.posexplode_outer("candidates").alias("k", "item"))


def _scored(t: Tables, item_vectors: DataFrame | None = None, split: str | None = None) -> DataFrame:
    vectors = item_vectors if item_vectors is not None else t.item_vectors
    users = recommend.user_vectors(recommend.interaction_counts(t.vector_events), vectors)
    candidates = _candidate_rows(t)
    return recommend.score_candidates(candidates.where(F.col("split") == split) if split else candidates, users, vectors)


_CANDIDATES = """eval AS (SELECT user_id, split, from_end, target, item_seq,
        list_sort(list_distinct(list_append(item_seq, target))) AS ex FROM vector_samples WHERE split <> 'train'),
    sized AS (SELECT *, (SELECT count(DISTINCT vec_id) FROM embeddings) - len(ex) AS left_over FROM eval),
    cand AS (SELECT user_id, split, from_end, target,
        list_prepend(target, list_transform(range(1, 100), lambda i: list_reduce(
            list_prepend(1 + CAST('0x' || substr(md5('42:' || user_id || ':' || from_end || ':' || i), 1, 8) AS BIGINT) % left_over, ex),
            lambda x, e: CASE WHEN e <= x THEN x + 1 ELSE x END))) AS candidates FROM sized)"""


@query(
    f"""WITH {_CANDIDATES} SELECT user_id, split, target, CAST(to_json(candidates) AS VARCHAR) AS candidates, FALSE AS short FROM cand""",
    "vector_samples",
)
def negative_candidates(t: Tables) -> DataFrame:
    rows = _eval_samples(t)
    return rows.select("user_id", "split", "target", as_text("candidates").alias("candidates"), "short")


@query(
    """WITH seen AS (SELECT user_id, list_sort(list(DISTINCT item)) AS ex FROM vector_events GROUP BY user_id),
    sized AS (SELECT s.*, ex, (SELECT count(DISTINCT vec_id) FROM embeddings) - len(ex) AS left_over
        FROM vector_samples s JOIN seen USING (user_id) WHERE split <> 'train')
    SELECT user_id, split, target, CAST(to_json(list_prepend(target, list_transform(range(1, 100), lambda i: list_reduce(
        list_prepend(1 + CAST('0x' || substr(md5('42:' || user_id || ':' || from_end || ':' || i), 1, 8) AS BIGINT) % left_over, ex),
        lambda x, e: CASE WHEN e <= x THEN x + 1 ELSE x END)))) AS VARCHAR) AS candidates, FALSE AS short FROM sized""",
    "vector_samples",
)
def negatives_outside_history(t: Tables) -> DataFrame:
    """Candidates that exclude everything the user ever had."""
    samples = sequences.training_samples(t.vector_events, RATING_ORDER, max_train_per_user=0).where("split <> 'train'")
    items = t.read("embeddings").agg(F.count_distinct("vec_id").alias("n")).scalar()
    rows = sampling.negatives_outside_history(samples, t.pairs, items)
    return rows.select("user_id", "split", "target", as_text("candidates").alias("candidates"), "short")


_VECTORS = f"""user_dims AS (SELECT user_id, i, avg(vec[i]) AS x FROM vector_events JOIN item_vectors USING (item),
        (SELECT unnest(range(1, {VECTOR_DIM + 1})) AS i) GROUP BY user_id, i),
    user_vec AS (SELECT user_id, list(x ORDER BY i) AS uvec FROM user_dims GROUP BY user_id)"""
_SCORES = f"""{_VECTORS}, {_CANDIDATES},
    rows AS (SELECT user_id, split, unnest(candidates) AS item, unnest(range(100)) AS k FROM cand),
    scored AS (SELECT user_id, split, CAST(k AS INTEGER) AS k, item, round(list_dot_product(uvec, vec), {SCORE_DIGITS}) + 0.0 AS score
        FROM rows LEFT JOIN user_vec USING (user_id) LEFT JOIN item_vectors USING (item))"""
_RANKS = f"""{_SCORES}, ranks AS (SELECT user_id, split, max(score) FILTER (WHERE k = 0) AS target_score,
        CAST(1 + count(*) FILTER (WHERE k > 0 AND (ts IS NULL OR score > ts)) AS INTEGER) AS rank
        FROM (SELECT *, max(score) FILTER (WHERE k = 0) OVER (PARTITION BY user_id, split) AS ts FROM scored)
        GROUP BY user_id, split)"""


@query(f"WITH {_SCORES} SELECT user_id, split, k, item, score FROM scored", "vector_samples", "item_vectors")
def score_candidates(t: Tables) -> DataFrame:
    return _scored(t).select("user_id", "split", "k", "item", "score")


@query(
    f"""WITH {_CANDIDATES}, rows AS (SELECT user_id, split, unnest(candidates) AS item, unnest(range(100)) AS k FROM cand)
    SELECT user_id, split, CAST(k AS INTEGER) AS k, item FROM rows
    WHERE NOT EXISTS (SELECT 1 FROM vector_events e WHERE e.user_id = rows.user_id AND e.item = rows.item)""",
    "vector_samples",
)
def unseen_candidates(t: Tables) -> DataFrame:
    kept = recommend.unseen_candidates(_candidate_rows(t), t.vector_events)
    return kept.select("user_id", "split", "k", "item")


def _ranks(t: Tables, item_vectors: DataFrame | None = None, split: str | None = None) -> DataFrame:
    scored = _scored(t, item_vectors, split).withColumn("is_target", F.col("k") == 0)
    return ranking.target_rank(scored, ["user_id", "split"])


@query(f"WITH {_RANKS} SELECT * FROM ranks", "vector_samples", "item_vectors")
def target_rank(t: Tables) -> DataFrame:
    return _ranks(t)


@query(
    f"WITH {_RANKS.replace('JOIN item_vectors', 'JOIN some_vectors')} SELECT * FROM ranks", "vector_samples", "some_vectors"
)
def target_rank_missing_vectors(t: Tables) -> DataFrame:
    """Ranks where every seventh item has a null for its vector: such a target comes last."""
    return _ranks(t, t.item_vectors.withColumn("vec", F.when(F.col("item") % 7 != 0, F.col("vec"))))


def _metric_sql(k: int) -> str:
    return f"""round(avg(CASE WHEN rank <= {k} THEN 1.0 ELSE 0.0 END), 9) AS "Hit@{k}",
    round(avg(CASE WHEN rank <= {k} THEN 1 / log2(rank + 1) ELSE 0.0 END), 9) AS "NDCG@{k}",
    round(avg(CASE WHEN rank <= {k} THEN 1 / CAST(rank AS DOUBLE) ELSE 0.0 END), 9) AS "MRR@{k}\""""


_METRICS = ", ".join(_metric_sql(k) for k in ranking.KS)


@query(f"WITH {_RANKS} SELECT {_METRICS} FROM ranks WHERE split = 'test'", "vector_samples", "item_vectors")
def ranking_metrics(t: Tables) -> DataFrame:
    metrics = ranking.ranking_metrics(_ranks(t, split="test"))
    return metrics.select(*[F.round(f"`{c}`", 9).alias(c) for c in metrics.columns])


@query(
    f"""WITH {_RANKS}, m AS (SELECT {_METRICS} FROM ranks WHERE split = 'test')
    SELECT 'test_' || replace(lower(name), '@', '_at_') AS metric, value FROM (UNPIVOT m ON COLUMNS(*) INTO NAME name VALUE value)""",
    "vector_samples",
    "item_vectors",
)
def ranking_metrics_long(t: Tables) -> DataFrame:
    metrics = ranking.ranking_metrics(_ranks(t, split="test"))
    return ranking.ranking_metrics_long(metrics).withColumn("value", F.round("value", 9))


_CODES = "SELECT internal_movie_id AS item, unnest([genre_idx_0, genre_idx_1, genre_idx_2]) AS code FROM movie_features"




@query(
    f"""WITH codes AS ({_CODES}), vecs AS (SELECT vec_id AS code, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
    means AS (SELECT item, i, avg(vec[i]) AS x FROM codes JOIN vecs USING (code),
        (SELECT unnest(range(1, {VECTOR_DIM + 1})) AS i) WHERE code > 0 GROUP BY item, i),
    pooled AS (SELECT item, sum(x) AS total, sum(x * i) AS weighted, max(x) AS largest FROM means GROUP BY item)
    SELECT internal_movie_id AS item, round(coalesce(total, 0), 6) AS total, round(coalesce(weighted, 0), 6) AS weighted,
    round(coalesce(largest, 0), 6) AS largest FROM movie_features LEFT JOIN pooled ON item = internal_movie_id""",
    "movie_features",
)
def masked_mean_pool(t: Tables) -> DataFrame:
    """Genre vectors pooled per movie, shown as checksums over the dimensions."""
    items = t.movie_features.select(
        F.col("internal_movie_id").alias("item"), F.array("genre_idx_0", "genre_idx_1", "genre_idx_2").alias("codes")
    )
    vectors = t.read("embeddings").select(F.col("vec_id").alias("item"), F.col("embedding").alias("vec"))
    pooled = recommend.masked_mean_pool(items, "codes", vectors, VECTOR_DIM)
    x = [F.get("pooled", F.lit(i)) for i in range(VECTOR_DIM)]
    total, weighted = x[0], x[0]
    for i in range(1, VECTOR_DIM):
        total, weighted = total + x[i], weighted + x[i] * (i + 1)
    return pooled.select(
        "item",
        (F.round(total, 6) + 0.0).alias("total"),
        (F.round(weighted, 6) + 0.0).alias("weighted"),
        (F.round(F.array_max("pooled"), 6) + 0.0).alias("largest"),
    )


def _recommend_sql(eligible: str = "TRUE", score: str = "list_dot_product(uvec, vec)") -> str:
    return f"""WITH {_VECTORS}, subset AS (SELECT item FROM item_vectors
        ORDER BY CAST('0x' || substr(md5('42:' || item), 1, 8) AS BIGINT), item LIMIT 200),
    pairs AS (SELECT user_id, item, round({score}, {SCORE_DIGITS}) + 0.0 AS score FROM user_vec, item_vectors
        WHERE {eligible} AND NOT EXISTS (
            SELECT 1 FROM vector_events e WHERE e.user_id = user_vec.user_id AND e.item = item_vectors.item)),
    best AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC NULLS LAST, item) AS rank FROM pairs)
    SELECT user_id, CAST(rank AS INTEGER) AS rank, movie_id, coalesce(title, 'Movie ' || movie_id) AS title,
    coalesce(array_to_string(genres, '|'), 'Unknown') AS genres, score, 'Prime Time (18:00-21:59)' AS time_slot
    FROM best JOIN vector_index ON item = item_idx LEFT JOIN movies USING (movie_id) WHERE rank <= {TOP_K}"""


def _recommend(t: Tables, item_vectors: DataFrame) -> DataFrame:
    users = recommend.user_vectors(t.pairs, t.item_vectors)
    # both counts come from the files' metadata; pairs bound the number of users
    ranked = recommend.top_k_items(
        users,
        item_vectors,
        t.pairs,
        TOP_K,
        size=VECTOR_DIM,
        n_items=t.vector_index.count(),
        n_users=t.pairs.count(),
    )
    return recommend.describe_recommendations(ranked, t.vector_index, t.movies)


@query(_recommend_sql(), "vector_events", "item_vectors", "movies")
def recommend_topk(t: Tables) -> DataFrame:
    """The ten best unseen items of the whole catalog for every user."""
    return _recommend(t, t.item_vectors)


@query(_recommend_sql("item IN (SELECT item FROM subset)"), "vector_events", "item_vectors", "movies")
def recommend_topk_eligible(t: Tables) -> DataFrame:
    """The same among the items of the seeded subset."""
    subset = sampling.eligible_subset(t.item_vectors, "item")
    return _recommend(t, t.item_vectors.join(subset, "item", "left_semi"))


@query(
    _recommend_sql("true", "CASE WHEN item % 4 <> 0 THEN list_dot_product(uvec, vec) END"),
    "vector_events",
    "item_vectors",
    "movies",
)
def recommend_topk_nonfinite(t: Tables) -> DataFrame:
    """The whole catalog with every fourth vector not a number: those items come last, without a score."""
    broken = F.when(F.col("item") % 4 == 0, F.transform("vec", lambda x: F.lit(float("nan")).cast("float")))
    return _recommend(t, t.item_vectors.withColumn("vec", broken.otherwise(F.col("vec"))))
