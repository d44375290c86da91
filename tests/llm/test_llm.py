"""The training-data operators against brute force, on small fixtures with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from parcelflow.llm import ann, bpe, licenses, line_dedup, lm_score, packing, sharding, simhash, spotsigs, toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_removed string, fp string, lane string"
ODD = ["", " ", "\n", "a", "a  b", "  x\n\n y  ", "<|endoftext|>", "a<|endoftext|> b", "ΑΣ ΣΑΣ İ K", "a\x1cb", "日本 語", "é é",
       "don't I'LL 12 3½", "aaaaaaaaaaaa aaa", "\x85a\xa0b", "😀😀 x", "word " * 3000, "tab\tand\r\nreturn"]


def rows() -> list[tuple]:
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [*ODD, None]
    for _ in range(40):
        lines = [" ".join(rnd.choices(words, k=rnd.randint(1, 12))) for _ in range(rnd.randint(1, 8))]
        texts.append("\n".join(lines))
    texts += texts[20:30] + [texts[25]] * 5
    out = [(i, t, None, None if i % 9 == 0 else f"s{i % 4}", None, "clash", "clash", "clash") for i, t in enumerate(texts)]
    return out + [(None, "no id", "en", "s1", 5, "", "", ""), (3, texts[3], None, None, None, "", "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts() -> dict:
    return {r[0]: r[1] or "" for r in rows()}


@pytest.mark.parametrize("kind,path", [(bpe.ByteBPE, BYTE), (bpe.WordBPE, WORD)])
def test_encoders_equal_the_library(kind, path):
    from tokenizers import Tokenizer

    rnd = random.Random(2)
    letters = "ab '\n\t st1.é  ñ<|>ΣA"
    cases = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    cases.append("<|endoftext|>".join(cases[20:30]))
    library, own = Tokenizer.from_file(path), kind(path)
    for _ in range(2):  # the second time from memory
        got = own.encode_batch(cases)
        for text, ids in zip(cases, got):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text
            if kind is bpe.ByteBPE:
                assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_round_trip(docs, empty):
    got = bpe.round_trip(docs, BYTE).toPandas()
    assert len(got) == len(rows()) and bpe.round_trip(empty, BYTE).count() == 0
    own = bpe.ByteBPE(BYTE)
    for r in got.dropna().itertuples():
        text = texts()[int(r.id)]
        ids = own.encode_batch([text])[0]
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("lane_tokens", [10_000_000, 700])
def test_packing(docs, empty, lane_tokens):
    assert packing.pack(empty, WORD).count() == 0
    p = packing.pack(docs, WORD, lane_tokens=lane_tokens).toPandas()
    own = bpe.WordBPE(WORD)
    counts = pd.Series([r[0] for r in rows()]).value_counts()
    stream = p.sort_values(["sequence_id", "offset"])
    lengths = stream.groupby("sequence_id")["length"]
    assert (stream["offset"] == lengths.cumsum() - stream["length"]).all()
    filled = lengths.sum()
    assert list(filled.index) == list(range(len(filled))) and (filled.iloc[:-1] == packing.WINDOW).all()
    for doc_id, part in p.dropna(subset="doc_id").groupby("doc_id"):
        ids = np.append(np.frombuffer(own.encode_batch([texts()[int(doc_id)]])[0], "<u4"), 1).astype("<u4")
        for r in part.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
        assert part["length"].sum() == len(ids) * counts[doc_id]


def test_round_robin_fills_windows_to_the_shares():
    def queue(n, share):
        ids = np.zeros(n, "<u2").tobytes()
        return packing._Queue(pd.DataFrame({"doc_id": [1], "n": [n], "ids": [ids]}), share, 0.0)

    queues = {"a": queue(60_000, 0.6), "b": queue(30_000, 0.3), None: queue(10_000, 0.1)}
    pieces = pd.DataFrame(list(packing.round_robin(queues, 0)), columns=list("dslcnqox"))
    share = pieces[pieces["q"] < pieces["q"].max() - 2].fillna("-").groupby(["q", "x"])["l"].sum().unstack(fill_value=0) / 2048
    assert abs(share.cumsum() - np.outer(np.arange(1, len(share) + 1), [0.1, 0.6, 0.3])).to_numpy().max() < 1


def test_hilbert_neighbours_are_adjacent_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = ann.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def vectors(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(300, 12)).astype(np.float32)
    listed = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    listed += [(300 + i, listed[7][1]) for i in range(150)]  # one vector a third of all rows have
    odd = [(1000, None), (1050, []), (1100, [0.0] * 12), (1150, [float("nan")] + [1.0] * 11),
           (1200, [float("inf")] + [1.0] * 11), (1250, [1.0, 2.0]), (None, listed[0][1]), (1300, [None] + [1.0] * 11)]
    return listed, spark.createDataFrame([(*r, "x") for r in listed + odd], "vec_id long, embedding array<float>, key string")


def test_nearest_neighbours(spark):
    listed, frame = vectors(spark)
    got = ann.search(frame, frame.where("vec_id % 50 = 0")).toPandas()
    x = np.array([v for _, v in listed])
    norm = np.sqrt((x * x).sum(1))
    want = []
    for q in range(0, 450, 50):
        s = np.round(x @ x[q] / norm / norm[q], 12)
        order = [j for j in sorted(range(len(x)), key=lambda j: (-s[j], j)) if j != q][:5]
        want += [(q, rank + 1, j) for rank, j in enumerate(order)]
    assert sorted(zip(got["query_id"], got["rank"], got["vec_id"])) == sorted(want)
    assert ann.search(frame.where("vec_id < 0"), frame).count() == 0
    few = frame.where("vec_id in (0, 1, 2)")
    assert ann.search(few, few.where("vec_id = 0")).count() == 2
    assert 0 < ann.search(frame, frame.where("vec_id % 50 = 0"), exact=False).count() <= len(want)


@pytest.mark.parametrize("exact", [True, False])
def test_equal_scores_of_different_vectors_go_to_smaller_ids(spark, exact):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(2, 12))
    listed = [(i, [float(x) for x in base[0] * 2.0 ** (i * 7 % 40 - 20)]) for i in range(40)]  # all differ, cosine 1
    listed += [(100 + i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(30, 12)))]
    listed += [(200 + i, [float(x) for x in np.eye(12)[i % 12] * (i + 1)]) for i in range(36)]  # cosine 0 or 1
    frame = spark.createDataFrame(listed, "vec_id long, embedding array<float>").repartition(3)
    got = ann.search(frame, frame.where("vec_id in (0, 5, 39, 203)"), exact=exact).toPandas().sort_values(["query_id", "rank"])
    x = np.array([v for _, v in listed], np.float32).astype(float)
    ids = [i for i, _ in listed]
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    for q in (0, 5, 39, 203):
        s = np.round(unit @ unit[ids.index(q)], 10)
        want = [i for i, _ in sorted(zip(ids, s), key=lambda p: (-p[1], p[0])) if i != q][:5]
        assert got.loc[got["query_id"] == q, "vec_id"].tolist() == want


def brute_fingerprint(text: str) -> int:
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.encode().lower()) if w]
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def reachable(fps: list[int], max_bits: int) -> list[int]:
    root = list(range(len(fps)))
    for _ in fps:
        before = list(root)
        for i, a in enumerate(fps):
            root[i] = min(root[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= max_bits)
        if root == before:
            break
    return root


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).toPandas()
    assert simhash.near_duplicates(empty).count() == 0 and len(got) == len(rows())
    assert (got["fingerprint"] == [f"{brute_fingerprint(texts()[None if pd.isna(i) else int(i)]):016x}"
                                   for i in got["doc_id"]]).all()
    fps = [int(f, 16) for f in got["fingerprint"]]
    root = reachable(fps, 3)
    want = got["doc_id"].groupby(root).transform("min")
    assert (got["component_id"].fillna(-1) == want.fillna(-1)).all()
    kept = simhash.keep_one(docs.where("doc_id is not null").dropDuplicates(["doc_id"]))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(
        set(got.dropna(subset="doc_id")["component_id"].dropna()))


def test_keep_one_keeps_a_row_of_every_group(spark):
    rnd = random.Random(7)
    far = [" ".join(rnd.choices([f"v{i}" for i in range(3000)], k=60)) for _ in range(7)]
    listed = [(None, far[0], "clean, no id"), (None, far[1], "a"), (None, far[1], "a"), (None, far[2], "loses"), (9, far[2], "id wins"),
              (5, far[3], "same id"), (5, far[3], "same id"), (5, far[4], "same id, other text"),
              (6, far[5], "first"), (7, far[5], "loses"), (7, far[6], "names its own group"), (None, None, "null text")]
    frame = spark.createDataFrame(listed, "doc_id long, text string, note string").repartition(4)
    kept = [tuple(r) for r in simhash.keep_one(frame).collect()]
    groups = simhash.near_duplicates(frame).select("fingerprint").distinct().count()
    assert len(kept) == groups == 8
    assert sorted(kept, key=str) == sorted([listed[i] for i in (0, 1, 4, 5, 7, 8, 10, 11)], key=str)


@pytest.mark.parametrize("hot", [simhash.HOT, 70])
def test_simhash_links_in_hot_anchors(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(250)}
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(200)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(nodes)).collect()}
    got = [roots.get(f, f) for f in signed]
    want = reachable(fps, 3)
    assert len({(a, b) for a, b in zip(got, want)}) == len(set(got)) == len(set(want))


@pytest.mark.parametrize("max_bits", [3, 5])
def test_simhash_splits_groups_that_share_half_their_bits(spark, monkeypatch, max_bits):
    """Fingerprints that differ in the same few bits all meet at one anchor, round after round."""
    monkeypatch.setattr(simhash, "HOT", 70)
    rng = random.Random(6)
    fps: set[int] = set()
    for base in (rng.getrandbits(64), rng.getrandbits(64)):
        places = rng.sample(range(0, 30), 14) + rng.sample(range(40, 64), 2)
        fps |= {base ^ sum(1 << p for p in places if rng.random() < 0.5) for _ in range(400)}
        fps |= {base ^ (1 << 62) ^ sum(1 << p for p in places[:4] if rng.random() < 0.5) for _ in range(20)}
    listed = sorted(fps)
    signed = np.array(listed, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    roots = {r.node: r.root for r in simhash.components(simhash.links(nodes, max_bits)).collect()}
    got = [roots.get(f, f) for f in signed]
    want = reachable(listed, max_bits)
    assert len({(a, b) for a, b in zip(got, want)}) == len(set(got)) == len(set(want))


def test_cover_meets_every_linked_pair():
    rng = random.Random(3)
    for bits in (3, 5):
        cover = simhash.Cover(bits // 2 + 1)
        a = [rng.getrandbits(64) for _ in range(300)]
        b = [x ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, bits))) for x in a]
        rows_a, found_a = cover.anchors(np.array(a, np.uint64))
        rows_b, found_b = cover.anchors(np.array(b, np.uint64))
        for i in range(300):
            assert set(found_a[rows_a == i]) & set(found_b[rows_b == i])
        x = np.array(a, np.uint64)
        assert (cover.rest(x, 0) == x >> np.uint64(cover.width)).all()
        assert (cover.rest(x, cover.blocks - 1) & np.uint64((1 << cover.shifts[-1]) - 1)
                == x & np.uint64((1 << cover.shifts[-1]) - 1)).all()


@pytest.mark.parametrize("copies", [0, 400])
def test_sharding(spark, docs, empty, copies):
    assert sharding.shard(empty).count() == 0
    hot = spark.range(copies).select((F.col("id") + 10_000).alias("doc_id"), F.lit("the same text " * 9).alias("text"))
    both = docs.select("doc_id", "text").unionByName(hot)
    got = sharding.shard(both).toPandas()
    assert len(got) == len(rows()) + copies and (got["law"] == "bytes").all() and got["grown_shard"].isna().all()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    known = got[got["doc_id"] < 10_000]
    assert all(s == len(texts()[int(i)].encode()) + 1 for i, s in zip(known["doc_id"], known["size"]))
    assert all(c == zlib.crc32(texts()[int(i)].encode()) for i, c in zip(known["doc_id"], known["text_crc32"]))
    if copies:
        total, sizes = got["size"].sum(), got.groupby("shard")["size"].sum()
        assert got["shard"].between(0, 15).all() and sizes.max() <= total / 16 + got["size"].max() + 1


def brute_shards(listed: list[tuple], shards: int) -> list[tuple]:
    """(id, hash, size, shard) in order, for rows (hash, id, number, size)."""
    listed = sorted(listed)
    total = sum(r[3] for r in listed)
    group = {}
    for h, _, _, size in listed:
        group[h] = group.get(h, 0) + size
    out, before, start = [], 0, {}
    for h, i, _, size in listed:
        start.setdefault(h, before)
        whole = group[h] <= total / shards / sharding.GROUP_PART
        middle = start[h] + group[h] / 2 if whole else before + size / 2
        out.append((i, h, size, min(shards - 1, int(middle * shards // total))))
        before += size
    return out


@pytest.mark.parametrize("texts_of", ["many", "hot", "few"])
def test_shards_equal_brute_force(spark, texts_of):
    rnd = random.Random(4)
    n = 12 if texts_of == "few" else 3000
    listed = [(rnd.randrange(n), "x" * rnd.randint(0, 40) + str(rnd.randrange(n))) for _ in range(n)]
    if texts_of == "hot":
        listed += [(7, "one text of one id") for _ in range(1500)] + [(None, None)] * 3
    frame = spark.createDataFrame(listed, "doc_id long, text string").coalesce(1).repartition(4)
    rows_ = sharding.staged(sharding.records(frame), "records")
    keyed = [(r.h, r.id, r.row, r.size) for r in rows_.collect()]
    want = brute_shards(keyed, 16)
    got = sharding.shard(frame).toPandas()
    low = np.iinfo(np.int64).min
    ids = [low if pd.isna(i) else int(i) for i in got["doc_id"]]
    count: dict = {}
    for i, h, size, k in want:
        count[(i, size, k)] = count.get((i, size, k), 0) + 1
    assert pd.Series(list(zip(ids, got["size"], got["shard"]))).value_counts().to_dict() == count
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_equal_rows_of_one_id_are_sampled_and_split(spark):
    """200,000 copies of one row: a bounded sample, and ranges of bounded size."""
    copies = 200_000
    rows_ = sharding.staged(sharding.records(spark.range(copies).select(
        F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))), "records")
    total = copies * 14
    drawn = sharding.sample(rows_.withColumn("range", F.lit(0)), F.lit(total), sharding.SAMPLE, 0)
    assert 0.9 * sharding.SAMPLE < len(drawn) < 1.1 * sharding.SAMPLE
    h = rows_.first()["h"]
    edges = sharding.splitters(rows_, total, 256, {h})
    sizes = [r["n"] for r in sharding.range_of(rows_, edges).groupBy("range").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 200 and max(sizes) <= 2 * copies / 256
    shards = sharding.shard(rows_.select("doc_id", F.lit("the same text").alias("text"))).groupBy("shard").count().collect()
    assert len(shards) == 16 and max(r["count"] for r in shards) - min(r["count"] for r in shards) <= 1


def test_toxicity_finds_misspellings_and_leaves_clean_texts(spark):
    rnd = random.Random(9)
    neutral = ["".join(rnd.choices("abcdeimnorst", k=rnd.randint(3, 9))) for _ in range(400)]
    bad = ["horribleword", "nastything", "vileness"]

    def text(toxic):
        words = rnd.choices(neutral, k=rnd.randint(5, 200))
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        return " ".join(words)

    marks = [(i, i % 4 == 0) for i in range(600)]
    frame = spark.createDataFrame([(i, text(t), "x") for i, t in marks] + [
        (2000, "nastythingg and horribleword5 " + " ".join(neutral[:50]), "x"), (2001, None, "x"), (2002, "", "x"), (None, "a", "x")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in marks] + [(None, 1, 1), (5000, 0, None)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, labels)
    got = toxicity.score(frame, model).toPandas().set_index("doc_id")
    held = [(i, t) for i, t in marks if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [bool(got.loc[i, "held_out"]) for i, _ in held] == [True] * len(held)
    assert np.mean([got.loc[i, "predicted"] == t for i, t in held]) > 0.95
    assert got.loc[2000, "predicted"] == 1 and got.loc[2001, "predicted"] == got.loc[2002, "predicted"] == 0
    assert got["score"].between(0, 1).all()
    kept = toxicity.keep_clean(frame, model)
    assert kept.columns == frame.columns and kept.count() == (got["predicted"] == 0).sum()
    assert toxicity.score(frame, toxicity.fit(frame, labels.where("toxic = 0"))).where("predicted = 1").count() == 0


def test_spotsigs(docs, empty):
    assert spotsigs.fingerprints(empty).count() == 0
    usable = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    for stretch in (4096, 7):
        got = spotsigs.fingerprints(usable, stretch_rows=stretch).toPandas().sort_values("doc_id")
        ids = sorted(i for i in texts() if i is not None)
        assert got["doc_id"].tolist() == ids
        for r, i, j in zip(got.itertuples(), ids, ids[1:] + ids[:1]):
            a, b = texts()[i], texts()[j]
            half = len(a) // 2
            changed = a[:len(a) - half] + b[:half]
            assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(changed.encode()).hexdigest())
            sa, sb, sc = (set(spotsigs.signatures(x).tolist()) for x in (a, b, changed))
            assert r.near_next == pytest.approx(len(sa & sb) / len(sa | sb))
            assert r.near_edited == pytest.approx(len(sa & sc) / len(sa | sc))
    one = spotsigs.fingerprints(usable.where("doc_id = 20")).toPandas()
    assert one["near_next"].tolist() == [1.0]


def test_spotsigs_pairs_equal_brute_force(spark):
    rnd = random.Random(6)
    stock = ["the", "of", "and"] + [f"c{i}" for i in range(30)]
    base = [rnd.choices(stock, k=rnd.randint(20, 60)) for _ in range(12)]
    listed = [" ".join(w if rnd.random() > 0.03 else "zz" for w in b) for b in base for _ in range(4)]
    frame = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
    got = {(r.a, r.b) for r in spotsigs.near_pairs(frame, 0.6).collect()}
    first: dict = {}
    for i, t in enumerate(listed):
        first.setdefault(tuple(spotsigs.signatures(t).tolist()), i)
    sets = [(i, np.array(k, np.uint64)) for k, i in first.items()]
    assert got == {(i, j) for i, a in sets for j, b in sets if i < j and spotsigs.likeness(a, b) >= 0.6}


def places(text: str) -> tuple:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_licenses(spark, docs, empty):
    listed = ["MIT License", "cc by cc by cc by", "x CC-BY-SA 4.0, y", "amit license mit licenses", "lİcense mİt license",
              "The GNU General Public License, version 2 or later. Apache License, Version 2.0",
              "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-2.0-only",
              "apache\nlicense – mit--license", "under CC - BY\n\nnow", "Creative\t Commons: Attribution", "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    frame = spark.createDataFrame([(1000 + i, t, "x") for i, t in enumerate(listed)], "doc_id long, text string, labels string")
    got = licenses.scan(frame.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))).toPandas()
    known = {**{1000 + i: t for i, t in enumerate(listed)}, **texts()}
    for r in got.itertuples():
        want = places(known[None if pd.isna(r.doc_id) else int(r.doc_id)])
        spot = [None if pd.isna(x) else int(x) for x in (r.first_word, r.last_word)]
        assert (r.n_words, r.n_base, *spot, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    labels = got.set_index("doc_id")["labels"]
    assert labels[1002] == "cc-by,cc-by-sa" and labels[1005] == "apache,apache-2.0,gpl,gpl-2-or-later"
    assert labels[1011] == "mit" and labels[1009] == labels[1010] == "cc-by" and len(licenses.rules()) > 200
    assert licenses.scan(empty).count() == 0 and licenses.scan(frame).where("doc_id = 1000").first()["score"] == 1.0


def examples(regex: str) -> list[str]:
    """Texts of a rule: all optional parts left out, all put in, and every alternative once."""
    from re import _constants as c
    from re import _parser

    def make(parts, full: bool, pick: int) -> str:
        out = ""
        for op, av in parts:
            if op is c.LITERAL:
                out += chr(av)
            elif op is c.SUBPATTERN:
                out += make(av[3], full, pick)
            elif op is c.BRANCH:
                out += make(av[1][pick % len(av[1])], full, pick)
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                out += make(av[2], full, pick) * (1 if full else av[0])
            elif op is c.IN:
                out += chr(av[0][1] if av[0][0] is c.LITERAL else av[0][1][0] if av[0][0] is c.RANGE else ord("x"))
            else:
                out += "x"
        return out

    parts = _parser.parse(regex)
    return sorted({make(parts, full, pick) for full in (False, True) for pick in range(3)})


def test_every_license_rule_can_be_reached(spark):
    rules = licenses.rules()
    texts = [(n, t) for n, r in enumerate(rules) for t in examples(r[2]) if "(" not in t]
    assert {n for n, _ in texts} == set(range(len(rules)))
    for n, t in texts:
        assert re.fullmatch(rules[n][2], t) and rules[n][1] in t, rules[n]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    got = licenses.scan(frame).select("doc_id", "n_words", "matches").collect()
    assert len(got) == len(texts)
    for r in got:  # the whole text is one place of the rule, unless a better rule takes it
        whole = [m for m in r["matches"] or [] if m["end"] - m["start"] == r["n_words"]]
        assert whole and (rules[r["doc_id"]][0] in {m["label"] for m in whole}
                          or min(m["priority"] for m in whole) < rules[r["doc_id"]][3]), rules[r["doc_id"]]
    tags = {"released under the WTFPL version 2": "wtfpl-2", "SPDX-License-Identifier: MIT": "mit", "dedicated to the public domain": "public-domain",
            "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "// SPDX-License-Identifier: BSD-3-Clause": "bsd-3",
            "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2-or-later", "SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1",
            "placed into the public domain": "public-domain", "GNU Library General Public License": "lgpl"}
    frame = spark.createDataFrame(list(enumerate(tags)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan(frame).collect()}
    assert [want in found[i].split(",") for i, want in enumerate(tags.values())] == [True] * len(tags)


def brute_chunks(spark, text: str) -> list[str]:
    lines = text.split("\n")
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(lines, [*lines[1:], None]))], "i int, a string, b string")
    rolling = [r.h for r in df.select("i", F.xxhash64(F.xxhash64("a"), F.when(F.col("b").isNotNull(), F.xxhash64("b"))).alias("h"))
               .orderBy("i").collect()]
    starts = [0] + [i for i in range(2, len(lines) - 1) if rolling[i] < rolling[i - 1] and rolling[i] < rolling[i + 1]]
    return ["\n".join(lines[i:j]) for i, j in zip(starts, [*starts[1:], len(lines)])]


def spans(texts_: list[str], text: str) -> list[tuple[int, int]]:
    """Line numbers of the chunks, with borders around long lines: (first, after the last)."""
    lines = text.split("\n")
    starts, at = {0}, 0
    for c in texts_:
        starts.add(at)
        at += c.count("\n") + 1
    for i, x in enumerate(lines):
        if len(x.split()) > 50:
            starts |= {i, i + 1}
    starts = sorted(x for x in starts if x < len(lines))
    return list(zip(starts, [*starts[1:], len(lines)]))


def brute_passages(spark, listed: list, ragged: bool = True) -> list:
    """By doc_id: the lines that stay; chunks first, then neighbouring lines of which one is left."""
    lines = [t.split("\n") if t is not None else [] for t in listed]
    seen, gone = set(), [set() for _ in listed]
    for d, t in enumerate(listed):
        for i, j in spans(brute_chunks(spark, t), t) if t is not None else []:
            unit = tuple(lines[d][i:j])
            if len(unit) > 1 or len(unit[0].split()) > 50:
                if unit in seen:
                    gone[d] |= set(range(i, j))
                seen.add(unit)
    if ragged:
        seen, chunks_gone = set(), [set(g) for g in gone]
        for d, ls in enumerate(lines):
            for i, (a, b) in enumerate(zip(ls, ls[1:])):
                if not {i, i + 1} <= chunks_gone[d] and (a.strip() or b.strip()):
                    if (a, b) in seen:
                        gone[d] |= {i, i + 1}
                    seen.add((a, b))
    return [None if t is None else "\n".join(x for i, x in enumerate(lines[d]) if i not in gone[d])
            for d, t in enumerate(listed)]


def passage_texts() -> tuple[list[str], list]:
    rnd = random.Random(12)
    passages = ["\n".join(f"passage {n} line {i}" for i in range(n)) for n in (2, 3, 4, 5, 7, 9, 12, 25)]
    passages += [" ".join(f"w{i}" for i in range(51)), "short\n" + " ".join(f"z{i}" for i in range(60)) + "\nends"]

    def own():
        return [f"own {rnd.random()}" for _ in range(rnd.randint(1, 7))]

    listed = ["\n".join([*own(), p, *own()]) for p in passages for _ in range(4)]
    listed += ["a\n\n\nb", "c\n\n\nd", "x\ny\nx\ny\nx", "one\ntwo", "one\ntwo", "", None, " ".join(f"v{i}" for i in range(50))]
    return passages, listed + [listed[-1], "single", "single", *["one\ntwo\nthree"] * 3]


@pytest.mark.parametrize("ragged", [True, False])
def test_line_dedup(spark, docs, empty, ragged):
    _, listed = passage_texts()
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(listed)], "doc_id long, text string, h string")
    got = line_dedup.dedup(frame.repartition(3), ragged=ragged).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got.columns.tolist() == ["doc_id", "text", "h", "n_removed", "chars_removed"]
    assert [None if pd.isna(t) else t for t in got["text"]] == brute_passages(spark, listed, ragged)
    kept = {x for t in got["text"].dropna() for x in t.split("\n")}
    assert kept >= {x for t in listed if t for x in t.split("\n")}
    again = line_dedup.dedup(docs)
    assert again.count() == docs.count() and set(docs.columns) <= set(again.columns)
    assert line_dedup.dedup(empty).count() == 0


def test_planted_passages_go_whole(spark):
    """Passages of two lines and more and long lines: each stays once, whole, wherever it stands."""
    passages, listed = passage_texts()
    frame = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
    got = line_dedup.dedup(frame).toPandas().sort_values("doc_id").reset_index(drop=True)
    for j, p in enumerate(passages):
        assert [p in t for t in got["text"].iloc[4 * j:4 * j + 4]] == [True, False, False, False]
        assert not set(p.split("\n")) & {x for t in got["text"].iloc[4 * j + 1:4 * j + 4] for x in t.split("\n")}
        assert got["n_removed"].iloc[4 * j:4 * j + 4].tolist() == [0, 1, 1, 1]
    # Whole chunks alone leave the ends, and short passages, behind.
    alone = line_dedup.dedup(frame, ragged=False).toPandas().sort_values("doc_id").reset_index(drop=True)
    cut = [sum(len(set(p.split("\n")) - set(t.split("\n"))) for t in alone["text"].iloc[4 * j + 1:4 * j + 4]) / 3 / len(p.split("\n"))
           for j, p in enumerate(passages)]
    assert cut[7] > 0.7 and cut[8] == 1.0


def test_line_dedup_with_nulls_and_repeated_rows(spark):
    listed = [(None, "p\nq\nr"), (1, "p\nq\nr"), (1, "p\nq\nr"), (2, "z\np\nq"), (2, "other\ntext"), (None, None), (3, None)]
    frame = spark.createDataFrame(listed, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup(frame).collect()), key=str)
    assert got == sorted([(None, "p\nq\nr"), (1, ""), (1, ""), (2, "z"), (2, "other\ntext"), (None, None), (3, None)], key=str)


def test_line_dedup_shuffles_the_texts_once(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"a{i % 5}\nb{i % 5}\nc{i}", "en") for i in range(200)], "doc_id long, text string, lang string")
    frame.write.parquet(str(tmp_path / "docs"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_dedup.dedup(spark.read.parquet(str(tmp_path / "docs")))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        plan = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
        dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(_line_dedup_rid" in x]
        assert "ReusedExchange [doc_id" in plan or "ReusedExchange" in plan and dealt
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("order,block", [(3, 8 << 20), (2, 500), (3, 900), (1, 700), (4, 400)])
def test_lm_scores(docs, empty, order, block):
    got = lm_score.score(docs, order=order, block_bytes=block).toPandas()
    assert len(got) == len(rows()) and lm_score.score(empty).count() == 0
    split = {k: [w for w in re.split(rb"[\x20\x09-\x0D]+", t.encode().lower()) if w] for k, t in texts().items()}
    all_rows = [split[r[0]] for r in rows()]
    counts: dict = {}
    for ws in all_rows:
        for k in range(1, order + 1):
            for i in range(len(ws) - k + 1):
                key = tuple(ws[i:i + k])
                counts[key] = counts.get(key, 0) + 1
    everything = sum(map(len, all_rows))

    def log_score(ws):
        total = 0.0
        for i in range(len(ws)):
            for back, k in enumerate(range(min(order, i + 1), 0, -1)):
                n = counts[tuple(ws[i - k + 1:i + 1])]
                if k == 1 or n >= 2:
                    total += np.log(n / (counts[tuple(ws[i - k + 1:i])] if k > 1 else everything)) + back * np.log(0.4)
                    break
        return total

    for r in got.itertuples():
        ws = split[None if pd.isna(r.doc_id) else int(r.doc_id)]
        assert r.n_words == len(ws) and r.log_score == pytest.approx(log_score(ws), abs=1e-3)


def test_pipeline_stages_follow_each_other(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
        assert docs.select("doc_id").join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        sizes.append(docs.count())
    assert sizes[1] == sizes[2] >= sizes[3] > 0.7 * sizes[0]
    assert docs.count() == docs.select("doc_id").distinct().count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == docs.count()
