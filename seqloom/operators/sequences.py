"""Per-user histories: sequences, leave-one-out split and history windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import arrays
from seqloom.operators.skew import RANK_LIMIT, last_rows_per_key, number_rows

MIN_SEQ_LEN = 5
MAX_SEQ_LEN = 50
HISTORY_BLOCK = 100_000

STEP = ["item", "slot", "genres"]


def _split_label(from_end: Column) -> Column:
    return F.when(from_end == 1, "test").when(from_end == 2, "val").otherwise("train")


def user_sequences(
    events: DataFrame,
    order: list[str],
    *,
    chunk: int,
    min_len: int = MIN_SEQ_LEN,
    profiles: DataFrame | None = None,
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Ordered lists of items, genres, slots and times per user with at least ``min_len`` events.

    A history longer than ``chunk`` comes out as several rows with consecutive ``part`` numbers, so no row grows
    with the most active user; ``seq_len`` is the length of the whole history. With ``profiles``, every row gets the struct
    of its user and users without a complete profile are left out.
    """
    numbered = number_rows(events, ["user_id"], order, size_from=size_from, max_rows=max_rows)
    numbered = numbered.where(F.col("n") >= min_len)
    step = F.struct("pos", *STEP, "rating_timestamp")
    parts = numbered.groupBy("user_id", F.floor((F.col("pos") - 1) / chunk).alias("part")).agg(
        F.sort_array(F.collect_list(step)).alias("s"), F.first("n").alias("seq_len")
    )
    kept = []
    if profiles is not None:
        parts, kept = attach_profile(parts, profiles), ["user_profile"]
    return parts.select(
        "user_id",
        "part",
        "seq_len",
        F.col("s.item").alias("item_seq"),
        F.col("s.genres").alias("genre_seq"),
        F.col("s.slot").alias("time_seq"),
        F.col("s.rating_timestamp").alias("timestamps"),
        *kept,
    )


def leave_one_out_split(
    events: DataFrame,
    order: list[str],
    *,
    min_len: int = MIN_SEQ_LEN,
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Each event of users with enough history, labelled train, val (second to last) or test (last)."""
    need = max(min_len, 3)
    return (
        number_rows(events, ["user_id"], order, size_from=size_from, max_rows=max_rows)
        .where(F.col("n") >= need)
        .withColumn("split", _split_label(F.col("n") - F.col("pos") + 1))
    )


def _capped_samples(
    events: DataFrame, order: list[str], min_len: int, max_seq_len: int, per_user: int, profiles: DataFrame | None
) -> DataFrame:
    """Samples for the last ``per_user + 2`` positions of every user.

    Nothing older than ``per_user + 2 + max_seq_len`` rows can appear in a sample, so every map task drops the rest
    before the exchange; the list collected per user has that length at most.
    """
    keep = max(per_user + 2 + max_seq_len, min_len)
    recent = last_rows_per_key(events, ["user_id"], order, keep)
    steps = F.collect_list(F.struct(F.col("_rn").alias("rn"), *STEP, "rating_timestamp"))
    tail = recent.groupBy("user_id").agg(F.sort_array(steps, asc=False).alias("s")).where(F.size("s") >= max(min_len, 3))
    kept = ["user_id"]
    if profiles is not None:
        # One row per user here, many per user below. The rows are partitioned by user already; the hint keeps Spark
        # from moving them on the strength of their small size before they are spread out.
        tail = attach_profile(tail, profiles.hint("shuffle_hash"))
        kept = ["user_id", "user_profile"]
    first = F.greatest(F.lit(2), F.size("s") - per_user - 1)
    at = tail.select(*kept, "s", F.explode(F.sequence(first, F.size("s"))).alias("at"))
    start = F.greatest(F.lit(1), F.col("at") - max_seq_len)
    return at.select(
        *kept,
        F.get("s", F.col("at") - 1).alias("t"),
        F.slice("s", start, F.col("at") - start).alias("h"),
        (F.size("s") - F.col("at") + 1).alias("from_end"),
    )


def _all_samples(
    events: DataFrame,
    order: list[str],
    min_len: int,
    max_seq_len: int,
    block: int,
    profiles: DataFrame | None,
    size_from: DataFrame | None,
    max_rows: int | None,
) -> DataFrame:
    """Samples for every position.

    A history is cut into blocks of ``block`` positions. Each block but the first starts with a copy of the
    ``max_seq_len`` rows before it, so all windows are complete and no task holds more than one block of a user.
    """
    if block < max_seq_len:
        raise ValueError("a block must hold at least one full history")
    numbered = number_rows(events, ["user_id"], order, size_from=size_from, max_rows=max_rows)
    numbered = numbered.where(F.col("n") >= max(min_len, 3))
    kept = []
    if profiles is not None:
        # rows are narrow and numbered here; later each of them carries a history
        numbered, kept = attach_profile(numbered, profiles), ["user_profile"]
    home = F.floor((F.col("pos") - 1) / block)
    ahead = F.floor((F.col("pos") - 1 + max_seq_len) / block)
    placed = numbered.withColumn("_home", home).withColumn("_block", F.explode(F.sequence(home, ahead)))
    w = Window.partitionBy("user_id", "_block").orderBy("pos").rowsBetween(-max_seq_len, -1)
    step = F.struct(*STEP)
    return (
        placed.withColumn("h", F.collect_list(step).over(w))
        .where((F.col("_block") == F.col("_home")) & (F.col("pos") >= 2))
        .select(
            "user_id",
            *kept,
            F.struct(*STEP, "rating_timestamp").alias("t"),
            "h",
            (F.col("n") - F.col("pos") + 1).cast("int").alias("from_end"),
        )
    )


def training_samples(
    events: DataFrame,
    order: list[str],
    *,
    min_len: int = MIN_SEQ_LEN,
    max_seq_len: int = MAX_SEQ_LEN,
    max_train_per_user: int | None = None,
    profiles: DataFrame | None = None,
    block: int = HISTORY_BLOCK,
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """One row per target position with its history of up to ``max_seq_len`` earlier events.

    ``events`` has user_id, item, slot, genres, rating_timestamp and the unique ``order`` columns. All positions are
    used; ``max_train_per_user`` keeps only the last so many train positions of a user, to bound what a classifier is
    fitted on.
    With ``profiles``, samples get the struct of their user and users without a complete profile are left out.
    ``size_from`` may name a cheaper frame with at least as many rows per user, see ``split_hot_groups``.
    """
    tail = None if max_train_per_user is None else max(max_train_per_user + 2 + max_seq_len, min_len)
    if tail is not None and tail <= RANK_LIMIT:
        samples = _capped_samples(events, order, min_len, max_seq_len, max_train_per_user, profiles)
    else:
        samples = _all_samples(events, order, min_len, max_seq_len, block, profiles, size_from, max_rows)
        if max_train_per_user is not None:
            samples = samples.where(F.col("from_end") <= max_train_per_user + 2)
    return samples.select(
        "user_id",
        _split_label(F.col("from_end")).alias("split"),
        "from_end",
        F.col("h.item").alias("item_seq"),
        F.col("h.genres").alias("genre_seq"),
        F.col("h.slot").alias("time_seq"),
        F.col("t.item").alias("target"),
        F.col("t.slot").alias("target_time"),
        F.col("t.rating_timestamp").alias("last_timestamp"),
        *(["user_profile"] if profiles is not None else []),
    )


def attach_profile(samples: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add the user profile as a struct; rows of users without a complete profile are dropped."""
    fields = ["age_idx", "gender_idx", "occupation"]
    known = profiles.select("user_id", *fields).na.drop()
    return samples.join(known, "user_id").withColumn("user_profile", F.struct(*fields)).drop(*fields)


def history_genres(events: DataFrame, features: DataFrame) -> DataFrame:
    """Events with the three genre codes of their item, zeros for an unknown item."""
    codes = features.select(
        F.col("internal_movie_id"), F.array("genre_idx_0", "genre_idx_1", "genre_idx_2").alias("genres")
    )
    return events.join(codes, "internal_movie_id", "left").withColumn(
        "genres", F.coalesce("genres", F.array_repeat(F.lit(0), 3))
    )


def pad_samples(samples: DataFrame, max_seq_len: int = MAX_SEQ_LEN, max_genres: int = 3) -> DataFrame:
    """Fixed-length item, slot and genre lists."""
    return samples.withColumns(
        {
            "item_seq": arrays.pad_left(F.col("item_seq"), max_seq_len),
            "time_seq": arrays.pad_left(F.col("time_seq"), max_seq_len),
            "genre_seq": arrays.pad_lists_left(F.col("genre_seq"), max_seq_len, max_genres),
        }
    )
