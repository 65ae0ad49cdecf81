"""Training-data operators against brute force on small tables, with nulls, empty texts, ties and repeated rows."""

import hashlib
import itertools
import math
import re
import textwrap
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from tokenizers import Tokenizer

from cuelake.llm import bpe_ops, chat, exact_dedup, license, lm, packing, quality, queries, simhash, sst, tokens, toxicity
from cuelake.llm.queries import tokenizer

import plain

D = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "a b", "x <|endoftext|> y", "İstanbul Σας 你好 12½", "same  text", "same\ttext", "word " * 3000, "L1 a\nL1 a\n\nL1 a", "a b c d e f g h a b c d e f g h a b c d e f g h"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, t string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{D}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "x", None, 1) for r in real]
    rows += [(10_000 + i, t, None, None, None, None, "t", None) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sst(spark, docs, texts, tmp_path):
    tk = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in sst.token_table(docs, tokenizer("byte_bpe_50k.json")).collect()}
    start = 0
    for i in sorted(texts):
        ids = tk.encode(texts[i], add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sst.token_table(empty(spark), tokenizer("byte_bpe_50k.json")).count() == 0
    path = tmp_path / "a.sst"
    with path.open("wb") as f:
        w = sst.SstWriter(f, 2)
        for i in range(-5000, 5000, 2):
            w.add(sst.key_of(i), bytes(200))
        w.close()
    with path.open("rb") as f:
        r = sst.SstReader(f, path.stat().st_size)
        assert len(r.blocks) > 2 and all(r.get(sst.key_of(i)) == bytes(200) for i in range(-5000, 5000, 22)) and r.get(sst.key_of(1)) is None


def test_word_encoder_latin():
    """Every character of the fast path, in four settings, and random texts of it."""
    tk, bpe = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), tokens.loaded(tokens.SpeculativeBpe, tokenizer("word_bpe_49k.json"))
    rng, latin = np.random.default_rng(6), [chr(c) for c in range(0x250)]
    odd = [t for c in latin for t in (c, f"a{c}b", f"{c} {c}{c}", f"1{c}x")] + ["".join(rng.choice(latin, 40)) for _ in range(3000)]
    odd += ["aƁb", "ƏZƏRİ Ɗan Ƒe", "A\u030a é e\u0301", " \n\t "]
    assert bpe.encode_batch(odd) == [tk.encode(t, add_special_tokens=False).ids for t in odd]


def test_bpe_odd_rows(spark):
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None), (2, ""), (2, "")], "doc_id long, text string")
    got = bpe_ops.encode_digests(odd, tokenizer("word_bpe_49k.json")).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 0, 2, 2] and bpe_ops.encode_digests(empty(spark), tokenizer("word_bpe_49k.json")).count() == 0


def test_sst_odd_rows(spark):
    odd = spark.createDataFrame([(None, "a b"), (None, None), (2, "x"), (2, "x"), (-4, "")], "doc_id long, text string")
    got = sorted(sst.token_table(odd, tokenizer("byte_bpe_50k.json")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -4, 2, 2] and [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_byte_level_encoder():
    """Ranks give the library's ids since every token merges to itself; see ``ByteLevelEncoder``."""
    assert tokens.ByteLevelEncoder(tokenizer("byte_bpe_50k.json")).merges_to_itself()
    tk, enc = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), tokens.ByteLevelEncoder(tokenizer("byte_bpe_50k.json"))
    assert enc.ranked
    rng, latin = np.random.default_rng(5), [chr(c) for c in range(0x250)]
    odd = ["".join(rng.choice(latin, 30)) for _ in range(2000)] + [" " * 300_000 + "a", " \n" * 200_000, "a" * 200_000, "aé" * 50_000, "x <|endoftext|> y", "你好 it's"]
    for t in odd:
        assert enc.ids(t).tolist() == tk.encode(t, add_special_tokens=False).ids


def test_bpe(docs, texts):
    tk = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    for r in bpe_ops.encode_digests(docs, tokenizer("word_bpe_49k.json")).collect():
        ids = tk.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    bpe = tokens.loaded(tokens.SpeculativeBpe, tokenizer("word_bpe_49k.json"))
    long = "".join(np.random.default_rng(3).choice(list("etaoinshrdluqzäßé"), 60_000))
    assert bpe.encode_batch([long])[0] == tk.encode(long, add_special_tokens=False).ids and bpe.exact_words
    pool = list(bpe.usable.values())[:3000:7]
    pairs = [(a, b) for a, b in itertools.product(pool[:60], pool) if not bpe.token[a].endswith("</w>")]
    ok = bpe.compatible(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    for (a, b), k in zip(pairs, ok):
        assert (bpe._exact(bpe._symbols(bpe.token[a]) + bpe._symbols(bpe.token[b])) == [a, b]) == k


@pytest.mark.parametrize("block, part, stretch", [(10**9, 10**9, 512), (4000, 20_000, 3)])
def test_lm(docs, texts, block, part, stretch):
    train = [lm._words(t) for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c = [Counter(), Counter(), Counter()]
    for t in train:
        for k in range(3):
            c[k].update(zip(*([lm.END, *t][j + (k == 0) :] for j in range(k + 1))))
    n, v, d = sum(c[0].values()), len(c[0]), lm.DISCOUNT

    def prob(history, w):
        """The longest history first, each drawn to the shorter."""
        if not history:
            return (c[0][w,] - d) / n if (w,) in c[0] else d * v / n
        return (c[len(history)][*history, w] + lm.PULL[len(history) - 1] * prob(history[1:], w)) / (c[len(history) - 1][history] + lm.PULL[len(history) - 1])

    every = [*(w for w, in c[0]), b"never seen"]
    for history in [(lm.END,), *list(c[0])[:3], (b"never seen",), *[h for h in list(c[1])[:40:10] if h[1] != lm.END]]:
        assert math.isclose(sum(prob(history, w) for w in every), 1, rel_tol=1e-9)
    rows = lm.scores(docs, block_chars=block, part_chars=part, stretch=stretch).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = lm._words(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum((x,) in c[0] for x in w), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((c[0][x,] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        read = [lm.END, *w]
        assert math.isclose(r.score, sum(math.log10(prob(tuple(read[max(0, i - 2) : i]), read[i])) for i in range(1, len(read))), rel_tol=1e-9)


def test_lm_edges(spark):
    assert lm.scores(empty(spark)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None), (2, ""), (2, "")], "doc_id long, text string")
    got = lm.scores(odd).collect()
    assert len(got) == 5 and all(math.isfinite(r.score) for r in got)
    out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = lm.scores(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert (only.train_tokens, only.n_known, only.base_score, only.score) == (0, 0, 0, 0)


def test_chat(spark):
    rows = [(1, 0, "user", "hi & <|im_end|> &lt;|"), (1, 1, "assistant", "a<|im_sep|>"), (1, 2, "assistant", "b\n"), (1, 2, "assistant", "b\n"), (2, 0, None, None), (None, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert set(got) == {1, 2, None} and got[1].n_turns == 4
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:4]).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256("a<|im_sep|>b\nb\n".encode()).hexdigest() and got[1].loss_chars == 15
    assert got[2].n_turns == 1 and got[2].loss_chars == 0
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0
    mark = "<|im_end|><|im_start|>assistant ok"
    hard = spark.createDataFrame([(-1, 0, "user", mark, "x"), (-1, 1, "assistant", mark, "y"), (5, 0, "assistant", "<| & " * 100_000, "z")], "conv_id long, turn long, role string, text string, ts string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(hard)).collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_sha256 == hashlib.sha256(mark.encode()).hexdigest() and got[5].loss_chars == 500_000


def test_packing(spark, docs, texts):
    tk = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    lengths = (64, 256, 1024)
    got = packing.pack(docs, tokenizer("byte_bpe_50k.json"), lengths=lengths, shard_tokens=20_000).collect()
    plain.check_bins(got, {i: tk.encode(t, add_special_tokens=False).ids + [packing.END_ID] for i, t in texts.items()}, lengths)
    assert len({r.shard for r in got}) > 1
    assert packing.pack(empty(spark), tokenizer("byte_bpe_50k.json")).count() == 0
    odd = spark.createDataFrame([(None, ""), (None, ""), (None, None), (3, "a b"), (3, "a b")], "doc_id long, text string")
    bins = packing.pack(odd, tokenizer("byte_bpe_50k.json")).collect()
    assert sorted((d is not None, d or 0) for r in bins for d in r.doc_ids) == [(False, 0)] * 3 + [(True, 3)] * 2


def test_packing_is_joint():
    """Never dearer than the largest length alone or any one way of opening; near the least cost of all partitions."""
    rng = np.random.default_rng(7)
    total = lambda plan: sum(map(packing.cost, plan[2]))
    lengths, dearer = (8, 16, 32), []
    for _ in range(60):
        sizes = rng.integers(1, 33, 6).tolist()
        plan = packing.joint_fit(sizes, lengths)
        for b, size in enumerate(plan[2]):
            assert sum(n for n, at in zip(sizes, plan[0]) if at == b) <= size
        assert total(plan) <= total(packing.best_fit(sizes, lengths[-1:], lengths))
        least = min(sum(packing.cost(next(c for c in lengths if c >= sum(sizes[i] for i in g))) for g in p) for p in plain.partitions(range(6)) if all(sum(sizes[i] for i in g) <= 32 for g in p))
        assert total(plan) >= least - 1e-9
        dearer.append(total(plan) / least)
    assert np.mean(dearer) < 1.03 and sum(x < 1 + 1e-9 for x in dearer) > 40
    sizes = rng.integers(1, 2000, 3000).tolist()
    assert total(packing.joint_fit(sizes)) < 0.97 * total(packing.best_fit(sizes, packing.LENGTHS[-1:]))


def test_quality(spark, docs, texts):
    trusted = [r.doc_id for r in docs.select("doc_id").limit(30).collect()]
    want = plain.quality(texts, set(trusted))
    kept = {True: 0, False: 0}
    for r in quality.score(docs, docs.where(docs.doc_id.isin(trusted)).select("doc_id")).collect():
        base, llr = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        assert math.isclose(r.llr, llr, rel_tol=1e-9, abs_tol=1e-9) and r.kept == (not r.base_failed and r.llr >= quality.THRESHOLD)
        kept[r.kept] += 1
    assert min(kept.values()) > 3
    assert quality.score(empty(spark), empty(spark)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None), (2, texts[trusted[0]]), (2, texts[trusted[0]])], "doc_id long, text string")
    got = quality.score(odd, odd.select("doc_id")).collect()
    assert len(got) == 5 and len({r.llr for r in got if r.doc_id == 2}) == 1


def _components(fp):
    ids = sorted(fp)
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(ids, 2):
            if comp[a] != comp[b] and bin(fp[a] ^ fp[b]).count("1") <= 2:
                low = min(comp[a], comp[b])
                for k in ids:
                    if comp[k] in (comp[a], comp[b]) and comp[k] != low:
                        comp[k], changed = low, True
    return comp


def test_simhash(spark, docs, texts):
    fp = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t))
        g = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    want = _components(fp)
    for r in simhash.near_groups(docs).collect():
        assert (r.fingerprint, r.component_id) == (f"{fp[r.doc_id]:016x}", want[r.doc_id])


def test_simhash_chain_and_crowd(spark):
    rng = np.random.default_rng(1)
    fps = [int(x) for x in rng.integers(0, 2**63, 50)]
    chain = [fps[0] ^ ((1 << 2 * k) - 1) for k in range(1, 20)]
    crowd = [fps[1] ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    every = sorted(set(fps + chain + crowd))
    signed = [(int(np.uint64(x).view(np.int64)), i) for i, x in enumerate(every)]
    nodes = simhash.distance_tables(spark.createDataFrame(signed, "fp long, label long"))
    root = {r.fp: r.root for r in simhash.components(simhash.links(nodes)).collect()}
    low = {}
    for f, i in signed:
        low[root.get(f, f)] = min(i, low.get(root.get(f, f), i))
    got = {f: low[root.get(f, f)] for f, _ in signed}
    arr = np.array(every, dtype=np.uint64)
    root = list(range(len(arr)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 2):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    for (f, i) in signed:
        assert got.get(f, i) == find(i)


def test_exact(spark, docs, texts):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in texts.items()}
    for r in exact_dedup.exact_groups(docs).collect():
        same = [i for i, t in norm.items() if t == norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(same), len(same), min(same) == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    odd = spark.createDataFrame([(None, "a  b"), (None, "a b"), (5, "a b"), (5, "a b"), (None, "x"), (None, "x"), (7, None), (3, "")], "doc_id long, text string")
    for rounds in (None, 1, 3):
        got = exact_dedup.exact_groups(odd, rounds=rounds).collect()
        assert sorted((r.keep_id is not None, r.keep_id or 0, r.group_size) for r in got if r.kept) == [(False, 0, 2), (True, 3, 2), (True, 5, 4)] and len(got) == 8


def test_simhash_odd_rows(spark):
    odd = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (9, "a b c d"), (None, "p q r s t"), (None, None), (4, ""), (4, "")], "doc_id long, text string")
    got = simhash.near_groups(odd).collect()
    assert len(got) == 7 and {r.component_id for r in got if r.fingerprint == "0" * 16} == {4}
    assert {r.component_id for r in got if r.fingerprint == f"{simhash.fingerprint('a b c d'):016x}"} == {9}
    assert simhash.near_groups(empty(spark)).count() == 0
    assert f"{simhash.fingerprint('w x y z ' * 100_000):016x}" == f"{simhash.fingerprint('w x y z ' * 50_000):016x}"


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    labelled = spark.read.parquet(f"{d}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    got = toxicity.score(labelled, toxicity.train(labelled, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 700 and (got.predicted == got.toxic).mean() > 0.98
    assert (got[got.toxic == 1].predicted == 1).mean() > 0.85 and (got[got.toxic == 0].predicted == 0).mean() > 0.99


def test_toxicity_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    g = toxicity.train(docs, none)
    assert toxicity.score(docs, g).count() == docs.count() and toxicity.score(empty(spark), g).count() == 0
    odd = spark.createDataFrame([(None, "a"), (None, "a"), (None, None), (2, "you fool " * 50_000), (2, "you fool " * 50_000)], "doc_id long, text string")
    got = toxicity.score(odd, toxicity.Grammar({"fool": 4.0})).collect()
    assert len(got) == 5 and not any(r.held_out for r in got if r.doc_id is None) and [r.predicted for r in got if r.doc_id == 2] == [1, 1]


def test_toxicity_rules():
    g = toxicity.Grammar({"fool": 4.0})
    w = g.weight
    assert w("You are a fool.") > w("a fool") > w("He said: fool") > w("not a fool") > 0 == w("nothing here")
    assert w("fool, you") == w("you fool") and w("fool. you") == w("fool")
    assert w("I will kill you") > w("kill") > 0 and w("I will kill you") > w("I will never kill you") and w("Ich töte dich") == w("I will kill you")
    assert w("he wrote that they will shoot us") < w("they will shoot us")
    assert w("not one of all these people here is a fool") == w("people fool")  # the negation reaches three words
    assert w("fool. " * 100) < 100 * w("fool")


def test_toxicity_machine():
    """The compiled table against a plain reading of the rules, over all short clauses."""
    after, out, end = toxicity.machine()
    place = {s: i for i, s in enumerate(toxicity.ALPHABET)}
    names = ("insult0", "threat", "target", "negation", "report", "other")
    for n in range(1, 6):
        for clause in itertools.product(names, repeat=n):
            state, got = 0, Counter()
            for s in clause:
                got.update(out[state][place[s]])
                state = after[state][place[s]]
            got.update(end[state])
            want = Counter()
            for i, s in enumerate(clause):
                if s not in toxicity.HITS:
                    continue
                negated = "negation" in clause[max(0, i - toxicity.NEGATION_REACH) : i]
                mark = "negated" if negated else "reported" if "report" in clause[:i] else "plain"
                want[toxicity.EVENTS.index((s, mark, False))] += 1
                later = [j for j in range(i + 1, n) if clause[j] == "target"]
                next_hit = min((j for j in range(i + 1, n) if clause[j] in toxicity.HITS), default=n)
                if "target" in clause[:i] or (later and later[0] < next_hit):
                    want[toxicity.EVENTS.index((s, mark, True))] += 1
            assert got == want, clause


def test_license(spark):
    text = {k: ts[0] for k, ts in license.TEXTS.items()}
    wrapped = lambda t, n=60: textwrap.fill(t, n)
    whole = {
        1: ("MIT", "Copyright 2020 A\n" + text["MIT"].replace("license", "licence").upper()),
        2: ("MIT", "MIT License\n\nCopyright (c) 2024 Somebody\nAll rights reserved.\n\n" + wrapped(text["MIT"])),
        3: ("MIT", "The MIT License (MIT)\n\n© 2024 Somebody\n\n" + wrapped(text["MIT"], 72)),
        4: ("ISC", "ISC License\n\nCopyright (c) 1995 X\n\n" + "\n".join(["Permission to use, copy, modify, and/or distribute this software for any", "purpose with or without fee is hereby granted, provided that the above", "copyright notice and this permission notice appear in all copies.", "", license._ISC_END])),
        5: ("BSD-3-Clause", "BSD 3-Clause License\nCopyright (c) 2001, U\n" + wrapped(text["BSD-3-Clause"].replace("Neither the name of the copyright holder", "Neither the name of Some Org").replace("SHALL THE COPYRIGHT HOLDER OR", "SHALL THE COPYRIGHT OWNER OR"))),
        6: ("BSD-2-Clause", text["BSD-2-Clause"]),
        7: ("Unlicense", wrapped(text["Unlicense"])),
        8: ("Zlib", text["Zlib"].replace("acknowledgment", "acknowledgement")),
        9: (None, text["MIT"] + " And more."),
        10: (None, "mit"),
        11: (None, None),
    }
    rows = [(i, t) for i, (_, t) in whole.items()] + [(20, "hello\nreleased under the MIT licence\n# SPDX-License-Identifier: GPL-2.0-or-later"), (None, "Licensed under CC BY-NC 4.0."), (None, "Licensed under CC BY-NC 4.0."), (21, ""), (21, ""), (22, "x " * 300_000)]
    got = license.scan(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, license string")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, (want, _) in whole.items():
        assert by_id[i].whole_license == want, i
    assert by_id[20].notices == "GPL-2.0,MIT" and by_id[20].n_notices == 2 and by_id[22].n_notices == 0
    assert [r.notices for r in got if r.doc_id is None] == ["CC-BY-NC-4.0"] * 2
    assert license.scan(empty(spark)).count() == 0


def test_license_long_texts(spark):
    """The digests of long licences against the copies that many systems have."""
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    have = [(k, Path("/usr/share/common-licenses", f)) for k, f in files.items() if Path("/usr/share/common-licenses", f).exists()]
    rows = [(i, p.read_text(errors="replace")) for i, (_, p) in enumerate(have)]
    got = {r.doc_id: r.whole_license for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: k for i, (k, _) in enumerate(have)}


@pytest.mark.parametrize("name", ["op3_chat_format", "op7_exact_dedup", "op10_license_scan"])
def test_sql(spark, name):
    con = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, D).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns) and len(got)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_quality_reads_words(spark):
    """Texts of one punctuation, and so of one shape, are told apart by their words and by the order of them."""
    rng = np.random.default_rng(11)
    good, spam = [f"prose{i}" for i in range(60)], [f"pills{i}" for i in range(20)]
    chain = lambda: [good[(s + k) % 60] for s in [int(rng.integers(60))] for k in range(40)]
    rows = [(i, " ".join(chain())) for i in range(300)]
    rows += [(1000 + i, " ".join(rng.choice(spam, 40))) for i in range(100)]
    rows += [(2000 + i, " ".join(rng.permutation(good)[:40])) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality.score(df, df.where("doc_id < 150").select("doc_id")).collect()}
    fresh, salad, ads = (np.array([r.llr for i, r in got.items() if a <= i < b]) for a, b in ((150, 300), (2000, 3000), (1000, 2000)))
    assert fresh.min() > salad.max() > ads.max()
    assert all(got[i].kept for i in range(300)) and not any(got[i].kept for i in range(1000, 1100))
