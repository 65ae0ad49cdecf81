"""Near copies against brute-force Jaccard similarity of five-word shingles."""

import numpy as np

import corpus_pipeline
from cuelake.llm import near_copies

import plain

D = "/root/testdata/sf0.001"


def _texts():
    rng = np.random.default_rng(2)
    texts = {}
    for i in range(30):
        base = [f"w{x}" for x in rng.integers(0, 3000, 200)]
        for k, edits in enumerate((0, 1, 3, 4, 6, 12)):
            words = list(base)
            for at in rng.choice(200, edits, replace=False):
                words[at] = f"edit{rng.integers(10**6)}"
            texts[100 * k + i] = " ".join(words)
    return texts


def test_edited_copies_are_dropped(spark):
    texts = _texts()
    low = plain.near(texts)
    rows = [(i, t, "en", "x", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{D}/documents.parquet").schema)
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, D).collect()}
    assert got == {i for i in texts if low[i] == i} and len(got) < 120


def test_crowd(spark, monkeypatch):
    """A family whose members lie around the limit of similarity, taken apart around centres."""
    monkeypatch.setattr(near_copies, "FEW", 3)
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in range(200)]
    texts = {}
    for i in range(24):
        words = list(base)
        for at in rng.choice(200, rng.integers(0, 14), replace=False):
            words[at] = f"edit{i}x{at}"
        texts[i] = " ".join(words)
    low = plain.near(texts)
    docs = spark.createDataFrame([(i, t, i) for i, t in texts.items()], "doc_id long, text string, row long")
    got = {r.doc_id: r.component_id for r in near_copies.near_groups(docs, "row").collect()}
    assert got == low


def test_members_apart_are_not_all_compared(spark, monkeypatch):
    """A family of which half lies just beyond the limit: only who shares rare differences is compared, and no link is lost."""
    from cuelake.shipping import materialize

    pairs = []

    def counted(rows, name):
        out = materialize(rows, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "FEW", 3)
    monkeypatch.setattr(near_copies, "materialize", counted)
    rng = np.random.default_rng(6)
    copy = lambda edits: " ".join(edits.get(x, f"w{x}") for x in range(150))
    texts = {0: copy({})}
    for i in range(70):
        at = rng.choice(150, 6, replace=False).tolist()
        near = {x: f"near{i}x{x}" for x in at[: 1 + i % 3]}
        far = {x: f"far{i}x{x}" for x in at}
        # Every sixth is beyond the limit from the origin, but not from the copy whose three edits it has.
        texts[1 + i], texts[101 + i] = copy(near), copy({x: far[x] for x in at[:5]} | near if i % 6 == 2 else far)
    low = plain.near(texts)
    docs = spark.createDataFrame([(i, t, i) for i, t in texts.items()], "doc_id long, text string, row long")
    got = {r.doc_id: r.component_id for r in near_copies.near_groups(docs, "row").collect()}
    assert got == low and 20 < len(set(low.values())) < 60
    assert pairs[-1] <= len(texts)


def test_families_of_fingerprints():
    """Pivot tables lose no step within the radius, with more pivots than members and with few; chains and strays included."""
    rng = np.random.default_rng(4)
    flip = lambda f, n: f ^ np.packbits(np.isin(np.arange(256), rng.choice(256, n, replace=False))).view(np.uint64)
    fps = [*rng.integers(0, 2**64, (60, 4), dtype=np.uint64)]
    for i in range(150):
        fps.append(flip(fps[i % 5 if i % 2 else -1], int(rng.integers(1, 90))))
    fps = np.array(fps)[rng.permutation(len(fps))]
    n, radius = len(fps), near_copies.radius_of(80)
    near = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2) <= radius
    low = np.arange(n)
    for _ in range(n):
        low = np.array([low[near[i]].min() for i in range(n)])
    for pivots in (1, 7, 256):
        got = near_copies.families(fps, radius, pivots)
        assert [got.tolist().index(x) for x in got] == low.tolist() and 1 < len(set(low.tolist())) < n


def test_similar_sets_meet():
    """Sets right at the limit of similarity share a place and lie within the radius."""
    rng = np.random.default_rng(5)
    dealt, radius = near_copies.blocks(80, 1000), near_copies.radius_of(80)
    sets = [rng.integers(0, 2**64, n + 2 * (n // 8), dtype=np.uint64) for n in rng.integers(64, 400, 500)]
    x, y = (np.array([near_copies.fingerprint(s[a : len(s) - len(s) // 10 + a]) for s in sets for a in [k * (len(s) // 10)]]) for k in (0, 1))
    assert (np.bitwise_count(x ^ y).sum(axis=1) <= radius).all()
    assert (near_copies.places(x, dealt) == near_copies.places(y, dealt)).any(axis=1).all()
    wide = near_copies.blocks(80, 1 << 26)
    assert wide.shape[1] > dealt.shape[1] and len(wide) > len(dealt)


def test_few_files(spark, monkeypatch):
    """Tables of a round have at most twice as many files as there are slots, however many partitions a shuffle has."""
    from cuelake.shipping import materialize

    files = {}

    def counted(rows, name):
        out = materialize(rows, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_copies, "materialize", counted)
    texts = _texts()
    docs = spark.createDataFrame([(i, t, i) for i, t in texts.items()], "doc_id long, text string, row long")
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 60)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.doc_id: r.component_id for r in near_copies.near_groups(docs, "row").collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got == plain.near(texts)
    assert max(files[n] for n in ("meetings", "pairs", "scored")) <= 2 * spark.sparkContext.defaultParallelism
