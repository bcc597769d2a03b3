"""SimHash, vector and edit-distance near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seqloom.llm import editprint, simhash, vectors
from seqloom.llm.common import components


def classes_of(near: np.ndarray) -> np.ndarray:
    label = np.arange(len(near))
    simhash.merge(label, *np.nonzero(np.triu(near, 1)))
    return label


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_simhash(rows):
    ids = [r.doc_id for r in rows]
    fps = np.array([plain_fingerprint(r.text) for r in rows], dtype=np.uint64)
    label = classes_of(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    least = {}
    for i, c in zip(ids, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, f"{int(f):016x}", least.get(c)) for i, f, c in zip(ids, fps, label, strict=True)), key=str)


@pytest.mark.parametrize("frame", ["documents", "awkward", "nothing"])
def test_simhash_against_brute_force(frame, request):
    docs = request.getfixturevalue(frame)
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == expected_simhash(docs.collect())


def spread(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2**64, n, dtype=np.uint64)
    y = x[rng.integers(0, n, 2 * n)]
    for _ in range(3):
        flip = np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64)
        y = np.where(rng.random(len(y)) < 0.7, y ^ flip, y)
    x = np.unique(np.concatenate([x, y]))
    rng.shuffle(x)
    return x


@pytest.mark.parametrize("n", [1000, 10**9, 10**13])
def test_index_finds_all_links(n):
    x = spread(1500, 4)
    label = np.arange(len(x))
    for mask in simhash.root_masks(n):
        root = x & np.uint64(mask)
        order = np.argsort(root, kind="stable")
        found = simhash.linked_classes(x[order], root[order])
        simhash.merge(label, order, order[found])
    assert np.array_equal(label, classes_of(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3))


def test_full_roots_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROOT_ROWS", 64)
    near = np.array([1 << b for b in range(64)] + [3 << b for b in range(63)], dtype=np.uint64)
    x = np.unique(np.concatenate([near, spread(100, 5)]))
    frame = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    edges = components(simhash.links(frame), "test").collect()
    root = {r.node: r.root for r in edges}
    label = classes_of(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    signed = x.view(np.int64)
    got = [root.get(int(v), int(v)) for v in signed]
    least = {c: min(int(v) for v, d in zip(signed, label, strict=True) if d == c) for c in set(label.tolist())}
    assert got == [least[c] for c in label.tolist()]


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "u long, v long")
    root = {r.node: r.root for r in components(frame, "test").collect()}
    assert all(root.get(i, 0) == 0 for i in range(51))
    assert all(root[100 + i] == 100 for i in range(1, 300))
    assert components(frame.where("u < 0"), "test").count() == 0


def vector_rows(seed=2, n=300, size=64):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size))
    near = base[rng.integers(0, 30, n)] + rng.normal(scale=0.13, size=(n, size)) * rng.random((n, 1))
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(np.concatenate([base, near]))]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(20)]
    rows += [(2000, None, 1), (2001, [0.0] * size, 1), (2002, [float("nan")] * size, 1), (2003, rows[0][1], None)]
    rows += [(2004, [None] * size, 1), (2005, [float("inf")] * size, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1)]
    return [*rows, (2008, [], 1)]


def expected_links(rows, threshold=0.98):
    good = [r[2] is not None and bool(r[1]) and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) for r in rows]
    near = np.zeros((len(rows), len(rows)), dtype=bool)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and good[i] and good[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], dtype=np.float64), np.array(b[1], dtype=np.float64)
                near[i, j] = x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    label = classes_of(near)
    return sorted(
        (r[0], int(near[i].sum()), rows[label[i]][0], rows[label[i]][0] == r[0]) for i, r in enumerate(rows)
    )


@pytest.mark.parametrize(("cell_rows", "dims"), [(2048, 0), (16, 0), (2048, 2)])
def test_vectors_against_brute_force(spark, monkeypatch, cell_rows, dims):
    monkeypatch.setattr(vectors, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vectors, "grid_dimensions", lambda n: dims)
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(1))
    got = sorted(tuple(r) for r in vectors.near_duplicates(frame).collect())
    assert got == expected_links(rows)
    assert sum(r[1] for r in got) > 200


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(frame).count() == 0


def plain_walk(text, number):
    """One walk, step by step, as ``editprint.walk`` defines it."""
    moves, bits = editprint.tables(number)
    coded = editprint._classes(text)
    at, t, octaves = int(len(coded) > 1 and moves[0][coded[0]]), 1, []
    octave = 0
    while at < len(coded) - 1:
        steps = set(editprint.sampled_steps(octave).tolist())
        got = []
        while t < 2 << octave:
            row, c = t % editprint.PERIOD, coded[at]
            if t in steps:
                got.append(int(bits[row][c]) if c else 0)
            at += int(moves[row][c])
            t += 1
        octaves.append(got)
        octave += 1
    return octaves


def test_walks_side_by_side_are_single_walks():
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("abcdefg hé"), int(n))) for n in rng.integers(0, 900, 60)]
    for text, walks in zip(texts, editprint.fingerprint_all(texts), strict=True):
        want = [plain_walk(text, number) for number in range(editprint.WALKS)]
        assert [[o.tolist() for o in octaves] for octaves in walks] == want
        assert [[o.tolist() for o in octaves] for octaves in editprint.parse(editprint.to_text(walks))] == want


def test_few_edits_stay_near():
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abcdefghijklmnop "), 4000))
    other = "".join(rng.choice(list("abcdefghijklmnop "), 4000))
    close = text[:1000] + "x" + text[1000:2500] + text[2503:]
    a, b, c, empty = editprint.fingerprint_all([text, close, other, ""])
    assert editprint.likeness(a, a) == 1
    assert editprint.likeness(a, b) > 0.6
    assert editprint.likeness(a, c) < 0.3
    assert editprint.likeness(empty, empty) == 1 and editprint.likeness(a, empty) == 0


@pytest.mark.parametrize("frame", ["documents", "awkward", "nothing"])
@pytest.mark.parametrize("chunks", [1, 5])
def test_comparison_with_the_next_document(frame, chunks, request):
    import hashlib

    docs = request.getfixturevalue(frame)
    rows = sorted(
        ((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    want = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        mine, other, after = editprint.fingerprint_all([text, changed, following])
        sha = hashlib.sha256(changed.encode()).hexdigest()
        near = editprint.likeness(mine, other), editprint.likeness(mine, after)
        want.append((i, len(text), sha, editprint.to_text(mine), editprint.to_text(other), *near))
    got = editprint.compare_with_next(docs.select("doc_id", "text"), chunks).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_banding_links_close_texts(spark):
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("abcdefghijklmnop "), 3000)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t[:1500] + "y" + t[1501:]) for i, t in enumerate(texts)]
    rows += [(200, texts[0]), (201, None), (202, "")]
    got = {r.doc_id: r.class_id for r in editprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == i for i in range(20))
    assert sum(got[100 + i] == i for i in range(20)) >= 18
    assert got[200] == 0 and got[202] == 201


@pytest.mark.parametrize("part_rows", [1024, 16])
def test_all_members_of_a_band_are_compared(spark, monkeypatch, part_rows):
    # texts of smaller ids share some bands with each pair and are like neither of it
    monkeypatch.setattr(editprint, "PART_ROWS", part_rows, raising=False)
    rng = np.random.default_rng(10)
    letters = list("abcdefghijklmnop ")

    def changed(text, n):
        at = int(rng.integers(0, len(text) - n))
        return text[:at] + "".join(rng.choice(letters, n)) + text[at + n :]

    rows = []
    for k in range(4):
        text = "".join(rng.choice(letters, 2000))
        rows += [(1000 * k + i, changed(text, 700)) for i in range(300)]
        rows += [(1000 * k + 900, text), *((1000 * k + 901 + i, changed(text, 160)) for i in range(5))]
    prints = dict(zip((i for i, _ in rows), editprint.fingerprint_all([t for _, t in rows]), strict=True))
    near = {(i, j): editprint.likeness(prints[i], prints[j]) for i in prints if i % 1000 == 900 for j in range(i + 1, i + 6)}
    pairs = [p for p, x in near.items() if x >= editprint.LIKENESS]
    found = editprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r.class_id for r in found}
    assert len(found) == len(rows) and len(pairs) >= 8
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.95 * len(pairs)


def test_query_runs_the_banding(spark, sf, documents):
    from seqloom.llm import queries

    found = queries.op7_edit_fingerprints(spark, sf).select("doc_id", "near_next", "class_id").collect()
    assert len(found) == documents.count()
    assert 0 < sum(r.class_id < r.doc_id for r in found) < len(found)


@pytest.mark.parametrize("frame", ["awkward", "nothing"])
def test_edit_classes_of_odd_rows(spark, frame, request):
    docs = request.getfixturevalue(frame)
    got = sorted(map(tuple, editprint.near_duplicates(docs).collect()), key=str)
    first = {}
    for r in docs.collect():
        same = "long" if r.doc_id in (7, 8) else r.text or ""  # 8 is 7 and one more word
        first.setdefault(same, []).append(r.doc_id)
    want = {i: min((x for x in ids if x is not None), default=None) for ids in first.values() for i in ids}
    assert got == sorted(((r.doc_id, want[r.doc_id]) for r in docs.collect()), key=str)


def test_edit_classes_keep_other_columns(spark):
    rows = [(i, t, "a", "b", 9) for i, t in enumerate(["same words here"] * 3 + ["quite another text", "", None])]
    frame = editprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, node string, first string, class_id int"))
    found = editprint.with_classes(frame)
    assert sorted(found.columns) == ["class_id", "doc_id", "fingerprint", "first"]
    assert {r.doc_id: r.class_id for r in found.collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4}


@pytest.mark.parametrize("kind", ["replaced", "inserted", "deleted"])
def test_edit_recall(spark, documents, kind):
    """Texts of some length with one edit in two hundred characters: nine of ten and more are found."""
    rng = random.Random(3)
    texts = [r.text for r in documents.collect() if r.text and 400 <= len(r.text) <= 6000][:60]

    def edit(text):
        out = list(text)
        for at in rng.sample(range(len(text)), max(1, len(text) // 200)):
            out[at] = {"replaced": "#", "inserted": out[at] + "#", "deleted": ""}[kind]
        return "".join(out)

    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, edit(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in editprint.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * i] == got[2 * i + 1] for i in range(len(texts))) >= 0.9 * len(texts)


def test_sketches_screen_only_texts_that_are_not_alike(documents):
    rng = random.Random(8)
    texts = [r.text for r in documents.collect() if r.text and len(r.text) >= 200][:80]
    changed = []
    for t in texts:
        out = list(t)
        for at in rng.sample(range(len(t)), max(1, len(t) // rng.choice([50, 100, 400]))):
            out[at] = rng.choice(["#", "", out[at] + "#"])
        changed.append("".join(out))

    def sketch(walk, number):
        packed = np.concatenate([np.packbits(o) for o in walk])[None]
        return int(editprint.sketches(packed, len(walk), number)[0]) & (2**64 - 1)

    most, near, far = editprint.sketch_distance(0.8), 0, 0
    prints, others = editprint.fingerprint_all(texts), editprint.fingerprint_all(changed)
    for a, b, c in zip(prints, others, prints[1:] + prints[:1], strict=True):
        for n in range(editprint.WALKS):
            if len(a[n]) == len(b[n]) and editprint.walk_likeness(a[n], b[n]) >= 0.8:
                near += 1
                assert (sketch(a[n], n) ^ sketch(b[n], n)).bit_count() <= most
            if len(a[n]) == len(c[n]) and editprint.walk_likeness(a[n], c[n]) < 0.3:
                far += (sketch(a[n], n) ^ sketch(c[n], n)).bit_count() > most
    assert most == 20 and near > 60 and far > 10


def random_prints(n, noise, seed):
    """Fingerprints of two walks of seven octaves: unrelated ones, or copies of one with that share of bits changed."""
    rng = np.random.default_rng(seed)
    sizes = [len(editprint.sampled_steps(k)) for k in range(7)]
    shape = (n, editprint.WALKS, sum(sizes))
    bits = rng.integers(0, 2, shape[1:]) ^ (rng.random(shape) < noise) if noise else rng.integers(0, 2, shape)
    cuts = np.cumsum(sizes)[:-1]
    return [(i, editprint.to_text([np.split(w.astype(np.uint8), cuts) for w in walks])) for i, walks in enumerate(bits)]


@pytest.mark.parametrize(("n", "noise"), [(12_000, 0), (100, 0.08)])
def test_compared_rows_grow_with_the_nodes(spark, monkeypatch, n, noise):
    # chance meetings of unrelated walks made rows with the square of their number; near copies that are not alike must not
    monkeypatch.setattr(editprint, "FEW_NODES", 12_000, raising=False)
    kind = type(spark.range(1))
    plain, made = kind.mapInArrow, []

    def counted(self, fn, schema, *more, **options):
        if schema == "u long, v long":
            made.append(self.count())
        return plain(self, fn, schema, *more, **options)

    monkeypatch.setattr(kind, "mapInArrow", counted)
    rows = []
    for size in (n, 4 * n):
        made.clear()
        frame = spark.createDataFrame(random_prints(size, noise, 12), "doc_id long, fingerprint string")
        assert editprint.with_classes(frame).count() == size
        rows.append(sum(made))
    assert rows[0] > 100 and rows[1] < 8 * rows[0]


@pytest.mark.parametrize("octaves", [8, 10])
def test_wider_bands_find_as_much(octaves):
    """Of pairs of walks near the likeness that is claimed, as many share a band of any width."""
    rng = np.random.default_rng(13)
    a = rng.integers(0, 2, (2000, 8 * int(editprint.octave_bytes(octaves).sum())), dtype=np.uint8)
    packed = np.packbits(np.concatenate([a, a ^ (rng.random(a.shape) < 0.1)]), axis=1)
    found = []
    for times in (1, 2, 4, 16, 256):
        keys, row = editprint.band_keys(packed, octaves, 0, *editprint.band_shape(editprint.FEW_NODES * times, 0.8))
        keys = keys[np.lexsort((keys, row))].reshape(len(packed), -1)
        found.append((keys[:2000] == keys[2000:]).any(axis=1).mean())
    assert found[0] > 0.9 and min(found) > found[0] - 0.01


def test_links_of_small_and_full_bands_meet(spark, monkeypatch):
    # a chain whose ends are not alike, beside it a band too full to be searched at once
    rng = np.random.default_rng(14)
    sizes = [len(editprint.sampled_steps(k)) for k in range(9)]
    base = rng.integers(0, 2, (editprint.WALKS, sum(sizes)), dtype=np.uint8)
    prints = []
    for i in range(40):
        bits = base.copy()
        bits[:, -1 - i % 8] ^= 1  # 40 walks, nearly equal
        bits[:, 40 + i] ^= 1
        prints.append(bits)
    for _ in range(4):  # each link changes a twelfth of the last octaves
        bits = prints[-1].copy()
        bits[:, rng.choice(np.arange(63, sum(sizes)), sum(sizes) // 14, replace=False)] ^= 1
        prints.append(bits)
    texts = [editprint.to_text([np.split(w, np.cumsum(sizes)[:-1]) for w in p]) for p in prints]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, fingerprint string")
    ends = editprint.parse(texts[0]), editprint.parse(texts[-1])
    assert editprint.likeness(*ends) < editprint.LIKENESS
    for most in (128, 8, 2):
        monkeypatch.setattr(editprint, "SMALL", most)
        assert {r.class_id for r in editprint.with_classes(frame).collect()} == {0}
