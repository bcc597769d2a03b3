"""Mixing, packing and the pipeline."""

import math
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from seqloom.llm import mixing, packing, queries, simhash, toxicity
from seqloom.llm.common import held_out


def test_targets_are_shared_by_weight_and_stop(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1), ("d", 0), (None, 500)]
    frame = spark.createDataFrame(sizes, "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    most = {s: 3.0 * n for s, n in sizes}
    total, open_ = float(sum(n for _, n in sizes)), set(weights)
    want = {}
    while True:
        level = (total - sum(want.values())) / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > most[s]}
        if not above:
            break
        want |= {s: most[s] for s in above}
        open_ -= above
    want |= {s: level * weights[s] for s in open_}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(total)


@pytest.mark.parametrize("frame", ["documents", "awkward", "nothing"])
def test_mix_takes_its_targets(frame, request):
    docs = request.getfixturevalue(frame)
    mixed = mixing.systematic_sample(docs)
    rows = mixed.collect()
    assert len(rows) == docs.count()
    assert sorted(map(tuple, mixing.systematic_sample(docs.repartition(5)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    for source, want in target.items():
        assert abs(taken[source] - want) <= 3 * largest[source]


def test_mix_equals_its_sql(spark, sf):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(db.sql(queries.SQL["op4_mix_sources"]).fetchall())
    got = queries.op4_mix_sources(spark, sf).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, got.collect())) == want


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [0] for e in encoder.encode_batch(texts, add_special_tokens=False)]


def check_packing(docs, pieces, capacity):
    """Pieces give back all ids in order, and sequences have no gap and no overflow."""
    rows = docs.collect()
    want = Counter()
    for r, ids in zip(rows, token_ids([r.text or "" for r in rows]), strict=True):
        head = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        at, k = 0, 0
        while at < len(ids):
            n = head if k == 0 else capacity
            crc = zlib.crc32(np.array(ids[at : at + n], dtype="<u4").tobytes())
            want[(r.doc_id, k, at, n, crc)] += 1
            at, k = at + n, k + 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("frame", ["documents", "awkward", "nothing"])
@pytest.mark.parametrize("capacity", [2048, 300])
def test_packing_gives_back_all_ids(frame, capacity, request):
    docs = request.getfixturevalue(frame)
    pieces = packing.pack_documents(docs, capacity).collect()
    used = check_packing(docs, pieces, capacity)
    least = math.ceil(sum(p.length for p in pieces) / capacity)
    assert used <= least + max(2, 0.02 * least)


def test_ids_are_those_of_the_vocabulary():
    import public_tokenizers

    encode = packing._encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["", " ", "a  b", "a \n b", "x  y  z", " lead", "trail ", "it's we'll 12 345.6!?", "é́ 日本 \U0001f600", "<|endoftext|> x", "\t\ta\r\n b\x1c c \x85d"]
    for text, want in zip(texts, token_ids(texts), strict=True):
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == want[:-1]


def test_local_search_empties_bins():
    lengths, capacity = [6, 6, 3, 3, 4, 4, 4], 10
    bins = [[0, 2], [1, 3], [4, 5], [6]]  # 9 9 8 4
    better = packing.local_search([list(b) for b in bins], lengths, capacity)
    assert sorted(i for b in better for i in b) == list(range(7))
    assert all(sum(lengths[i] for i in b) <= capacity for b in better)
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 700, 3000).tolist()
    start = packing.best_fit(lengths, 1000)
    end = packing.local_search([list(b) for b in start], lengths, 1000)
    assert len(end) <= len(start)
    assert sorted(i for b in end for i in b) == list(range(3000))

    def squares(bins):
        return sum(sum(lengths[i] for i in b) ** 2 for b in bins)

    assert squares(end) >= squares(start)


def test_pipeline_keeps_clean_documents(spark, sf, documents):
    rows = {r.doc_id: r for r in documents.collect()}
    docs = documents
    kept = corpus_pipeline.clean(spark, docs, sf)
    usable = ~held_out("doc_id", 5, 0)
    model = toxicity.train(documents, spark.read.parquet(f"{sf}/labels.parquet"), usable)
    clean_ids = {i for i, r in rows.items() if toxicity.score_text(r.text or "", model)[0] < 0.5}
    assert {r.doc_id for r in kept.collect()} == clean_ids
    assert kept.columns == documents.columns
    deduped = corpus_pipeline.near_duplicates(spark, kept, sf)
    groups = simhash.near_duplicates(kept).collect()
    assert sorted(r.doc_id for r in deduped.collect()) == sorted({r.component_id for r in groups})
    assert corpus_pipeline.near_duplicates(spark, kept.unionByName(kept), sf).count() == deduped.count()
    hidden = corpus_pipeline.hide_secrets(spark, deduped, sf).collect()
    assert len(hidden) == deduped.count()
    assert all(r.text == rows[r.doc_id].text or "[SECRET]" in r.text for r in hidden)
    mixed = corpus_pipeline.mix(spark, deduped, sf)
    copies = Counter(r.doc_id for r in mixed.collect())
    want = {r.doc_id: r.copies for r in mixing.systematic_sample(deduped).collect() if r.copies}
    assert copies == want
    assert mixed.columns == documents.columns
    check_packing(mixed, corpus_pipeline.pack(spark, mixed, sf).collect(), packing.CAPACITY)


def test_pipeline_runs_on_awkward_rows(spark, awkward, nothing, sf):
    for frame in (awkward, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == corpus_pipeline.COLUMNS
        pieces = corpus_pipeline.pack(spark, docs, sf).collect()
        check_packing(docs, pieces, packing.CAPACITY)


def test_rows_without_id_are_deduplicated_too(spark, sf):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l m"), (3, "g h i j k l m"), (4, "n o p")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == [(3, "g h i j k l m"), (4, "n o p"), (None, "a b c d e f")]


@pytest.mark.parametrize("stored", [True, False])
def test_rows_of_one_id_are_mixed_and_kept_apart(spark, sf, tmp_path, stored):
    """Words taken reach the targets although ids are null or repeated, and no text of another group goes with its id."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        words = " ".join(rng.choices([f"w{k}" for k in range(5000)], k=rng.randint(5, 40)))
        rows.append((rng.choice([None, None, i, 5, i % 40]), words, "en", rng.choice("aab") if i % 7 else None, len(words)))
    rows += rows[:200]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    if stored:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    sample = mixing.systematic_sample(docs).collect()
    mixed = corpus_pipeline.mix(spark, docs, sf).collect()
    assert len(mixed) == sum(r.copies for r in sample)
    for source in {r.source for r in sample}:
        own = [r for r in sample if r.source == source]
        taken = sum(len(r.text.split()) for r in mixed if r.source == source)
        assert abs(taken - own[0].target) <= 3 * max(r.size for r in own)
    assert {tuple(r) for r in mixed} <= set(rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, sf).collect()
    assert sorted(r.text for r in kept) == sorted({t for _, t, *_ in rows})  # random texts have no near copies
    for r in kept:
        ids = [i for i, t, *_ in rows if t == r.text]
        assert r.doc_id == min((i for i in ids if i is not None), default=None)


def test_loose_sequences_of_all_groups_meet_again(spark):
    """Many small groups end within half a sequence a round of the bound; pieces that cannot go together end too."""
    rng = random.Random(2)
    rows = [(i, 0, 0, min(1000, int(rng.lognormvariate(4.5, 1.0)) + 1), i) for i in range(6000)]
    frame = spark.createDataFrame(rows, packing.PIECES)
    out = packing.pack(frame, 1000, group=150).collect()
    assert sorted((r.doc_id, r.length) for r in out) == [(i, n) for i, _, _, n, _ in rows]
    fills = Counter()
    for r in out:
        fills[r.sequence_id] += r.length
    least = math.ceil(sum(n for *_, n, _ in rows) / 1000)
    assert max(fills.values()) <= 1000 and len(fills) <= 1.01 * least
    alike = packing.pack(spark.createDataFrame([(i, 0, 0, 700, i) for i in range(500)], packing.PIECES), 1000, group=60)
    assert alike.select("sequence_id").distinct().count() == 500


def test_like_lengths_are_searched_in_seconds():
    lengths = np.random.default_rng(1).integers(640, 761, 8192).tolist()
    start = packing.best_fit(lengths, 2048)
    began = time.time()
    end = packing.local_search([list(b) for b in start], lengths, 2048)
    assert time.time() - began < 10 and len(end) < 0.97 * len(start)
    assert sorted(i for b in end for i in b) == list(range(8192))
    assert max(sum(lengths[i] for i in b) for b in end) <= 2048
