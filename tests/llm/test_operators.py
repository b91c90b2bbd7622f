"""Every operator against a brute-force version on small tables with nulls, ties, empty and long texts, and odd columns."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from lakelens.llm import chat, dedup, encoding, lm, mixing, neardup, packing, queries, rules, tokenstore, toxicity, weaklabels
from lakelens.llm.common import materialize, shared_path, trim_driver
from lakelens.llm.textstats import text_stats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, h string, size string, label string, d double"


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 90))) for _ in range(n)]
    for t in texts[: n // 3]:
        words = t.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(words))
    shared = " ".join(rng.choice(vocab) for _ in range(60))
    texts += [f"{shared} {t}" for t in texts[:20]]
    texts += [None, "", " \n\t", "one", "One", "two words", "one", "Ünïcode \x1c\x85 x  y\n\n z ", "a b c d e " * 400, texts[0], texts[0].upper(), texts[1].replace(" ", "\n"), "<|endoftext|> tail  "]
    rows = [(i * 3 % 1000, t, rng.choice(["en", None, "de"]), rng.choice(["a", "b", "b", "b", None, "z"]), 1, 2, "k", "h", "s", "l", 0.5) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, "a row without id", None, None, *rows[0][4:]), (7777, texts[2], "en", "a", *rows[0][4:])]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kind", [encoding.word_bpe, encoding.byte_bpe])
def test_encoder_equals_library(kind):
    enc, rng = encoding.Encoder(*kind()), random.Random(3)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\x00", "a", "B", "é", "́", ".", "'s", "1", "12", "Σ", "ς", "\xa0", "\x1c", "\x85", "　", "<|endoftext|>", "|", "<", "😀", "\r\n", "ß", "word,", "Word."]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 10)))
        assert enc.encode(text) == enc.direct(text), repr(text)


@pytest.mark.parametrize("kind", [encoding.word_bpe, encoding.byte_bpe])
def test_encoder_of_batches(kind, rows, monkeypatch):
    """Slices, memo generations and gathers of any size give the library's ids; so do very long words."""
    monkeypatch.setattr(encoding, "SLICE_BYTES", 300)
    monkeypatch.setattr(encoding, "GATHER", 7)
    enc = encoding.Encoder(*kind())
    enc.memo.most, enc.bare.most = 40, 8
    texts = [*(r[1] for r in rows), "x" * 5000 + " tail", "é" * 40 + "." * 300, None]
    got = {}
    for first, ids, counts in enc.batches(pa.array([None, *texts]).slice(1)):
        for k, x in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            got[first + k] = x.tobytes()
    assert [got[k] for k in range(len(texts))] == [enc.direct(t or "") for t in texts]


def test_token_store(spark, docs, rows):
    root = shared_path(spark, "store")
    manifest = tokenstore.write_store(docs, root, shards=5)
    got = tokenstore.scan_store(spark, root, manifest).collect()
    direct = encoding.Encoder(*encoding.word_bpe())
    assert len(got) == len(rows)
    want = collections.Counter((r[0], crc([*np.frombuffer(direct.direct(r[1] or ""), "<u4"), 1])) for r in rows)
    assert collections.Counter((x.doc_id, x.ids_crc32) for x in got) == want
    ordered = sorted(got, key=lambda x: x.start)
    at = 0
    for x in ordered:
        assert x.start == at
        at += x.n_tokens
    known = [x.doc_id for x in ordered if x.doc_id is not None]
    assert known == sorted(known) and ordered[0].doc_id is None
    assert len({(x.doc_id, x.occurrence) for x in got}) == len(got)
    shard = tokenstore.Shard(root, next(m.shard for m in manifest.collect() if m.n_docs), 2)
    missing = np.arange(10**6, 10**6 + 500)
    offsets, _ = shard.find(missing, np.zeros(500, np.int64))
    assert (offsets < 0).mean() > 0.99
    keys, seen = shard.keys()
    assert sorted(shard.slot(keys[k : k + 1], seen[k : k + 1]) for k in range(len(keys))) == list(range(len(keys)))  # minimal and perfect


def test_token_store_lookup(spark, docs, rows):
    """Every key is found in its shard by reading its index at a few places; unknown ones aren't found."""
    root = shared_path(spark, "store")
    store = tokenstore.Store(root, tokenstore.write_store(docs, root, shards=5))
    direct, count = encoding.Encoder(*encoding.word_bpe()), collections.Counter()
    want = collections.defaultdict(list)
    for r in rows:
        want[r[0]].append([*np.frombuffer(direct.direct(r[1] or ""), "<u4"), 1])
    for doc_id, texts in want.items():
        got = [store.lookup([doc_id], k)[0].tolist() for k in range(len(texts))]
        assert sorted(got) == sorted(texts)
        assert store.lookup([doc_id], len(texts)) == [None]
        count[len(texts)] += 1
    assert max(count) > 1 and store.lookup([10**6, -5, 2**53 + 1]) == [None] * 3


def test_token_store_large_ids_beside_a_null(spark):
    ids = [None, 2**53, 2**53 + 1, 2**53 + 2, -(2**63), 2**63 - 1]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string").coalesce(1)
    root = shared_path(spark, "store")
    manifest = tokenstore.write_store(docs, root, shards=2)
    got = tokenstore.scan_store(spark, root, manifest).orderBy("start").collect()
    assert [(x.doc_id, x.occurrence) for x in got] == [(i, 0) for i in sorted(ids, key=lambda i: (i is not None, i or 0))]
    assert all(x is not None for x in tokenstore.Store(root, manifest).lookup(ids))


def test_token_store_one_id_over_shards(spark):
    """A repeated doc_id spreads over shards, and its occurrences are numbered over all of them."""
    docs = spark.createDataFrame([(7, f"text number {k} " + "word " * (k % 9)) for k in range(400)] + [(8, "x")], "doc_id long, text string")
    root = shared_path(spark, "store")
    manifest = tokenstore.write_store(docs, root, shards=4)
    assert sum(x.n_docs > 0 for x in manifest.collect()) > 2
    got = tokenstore.scan_store(spark, root, manifest).collect()
    assert sorted(x.occurrence for x in got if x.doc_id == 7) == list(range(400))
    store = tokenstore.Store(root, manifest)
    by = {x.occurrence: x.ids_crc32 for x in got if x.doc_id == 7}
    assert all(crc(store.lookup([7], k)[0]) == by[k] for k in range(0, 400, 13)) and store.lookup([7], 400) == [None]


def test_token_store_of_a_large_vocabulary(spark, tmp_path):
    """Ids beyond two bytes are kept whole, and refused where two bytes are asked for."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    made = Tokenizer(models.WordLevel({f"w{i}": i for i in range(70_000)}, unk_token="w0"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    made.save(path := str(tmp_path / "words.json"))
    docs = spark.createDataFrame([(1, "w69999 w5"), (2, "w65536"), (3, None)], "doc_id long, text string")
    root = shared_path(spark, "store")
    got = tokenstore.scan_store(spark, root, tokenstore.write_store(docs, root, (path, True))).collect()
    assert {x.doc_id: x.ids_crc32 for x in got} == {1: crc([69999, 5, 1]), 2: crc([65536, 1]), 3: crc([1])}
    with pytest.raises(Exception, match="does not fit"):
        tokenstore.write_store(docs, shared_path(spark, "store"), (path, True), width=2)


def test_token_store_empty(spark, empty):
    root = shared_path(spark, "store")
    assert tokenstore.scan_store(spark, root, tokenstore.write_store(empty, root)).count() == 0


def brute_components(rows):
    sets = []
    for r in rows:
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in r[1] or ""))
        k = min(5, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return collections.Counter((r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows))


def test_jaccard_join(docs, rows):
    got = collections.Counter((x.doc_id, x.n_shingles, x.component_id) for x in neardup.near_duplicates(docs).collect())
    assert got == brute_components(rows)


def test_jaccard_join_chains(spark, tmp_path):
    """Chains of edits, sets around the threshold, and a passage that most documents share."""
    rng = random.Random(5)
    rows, passage = [], [f"p{i}" for i in range(70)]
    for g in range(12):
        words = [f"w{g}_{i}" for i in range(rng.choice([6, 12, 30, 60]))]
        for _ in range(8):
            words = list(words)
            words[rng.randrange(len(words))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, " ".join([*passage, *[f"t{i}_{j}" for j in range(rng.choice([3, 10, 16, 18, 20, 40]))]])) for i in range(60)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    got = collections.Counter((x.doc_id, x.n_shingles, x.component_id) for x in neardup.near_duplicates(spark.read.parquet(path)).collect())
    assert got == brute_components(rows)


def brute_links(rows):
    """(doc_id, other rows at a similarity of 0.8 or more) of each row."""
    sets = []
    for r in rows:
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in r[1] or ""))
        k = min(5, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    near = lambda a, b: bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    return collections.Counter((r[0], sum(near(a, b) for j, b in enumerate(sets) if j != i)) for i, (r, a) in enumerate(zip(rows, sets, strict=True)))


def test_jaccard_join_counts_links(docs, rows):
    got = collections.Counter((x.doc_id, x.n_links) for x in neardup.near_duplicates(docs).collect())
    assert got == brute_links(rows)


def test_jaccard_join_links_within_families(spark, tmp_path):
    """Families of differing near copies, at all distances around the limit, with copies among them: no link is left out."""
    rng, rows = random.Random(8), []
    for g in range(10):
        words = [f"w{g}_{i}" for i in range(rng.choice([8, 40, 90, 150]))]
        for _ in range(9):
            near = list(words)
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = f"x{rng.random()}"
            rows += [(len(rows), " ".join(near))] * rng.choice([1, 1, 1, 2])
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    want = brute_links(rows)
    assert max(n for _, n in want) > 8
    got = collections.Counter((x.doc_id, x.n_links) for x in neardup.near_duplicates(spark.read.parquet(path)).collect())
    assert got == want


@pytest.mark.parametrize("edits", [[2], [0, 1, 2, 3]])
def test_jaccard_join_makes_no_rows_of_the_pairs_of_a_family(spark, tmp_path, monkeypatch, edits):
    """One family of differing near copies, linked, just below the limit or mixed, with copies among them: every link is counted,
    and what lies between holds a few rows for a set, not one for a pair."""
    rng = random.Random(3)
    words, rows, made = [f"w{i}" for i in range(100)], [], collections.Counter()
    for _ in range(120):
        near = list(words)
        for _ in range(rng.choice(edits)):
            near[rng.randrange(len(near))] = f"x{rng.random()}"
        rows += [(len(rows) + i, " ".join(near)) for i in range(rng.choice([1, 1, 1, 2]))]
    rows += [(len(rows) + i, " ".join(f"y{i}_{j}" for j in range(30))) for i in range(20)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    materialize = neardup.materialize

    def counting(df, name):
        got = materialize(df, name)
        made[name] = max(made[name], got.count())
        return got

    monkeypatch.setattr(neardup, "materialize", counting)
    monkeypatch.setattr(neardup, "DENSE_SETS", 40, raising=False)
    got = neardup.near_duplicates(spark.read.parquet(path)).collect()
    assert collections.Counter((x.doc_id, x.n_links) for x in got) == brute_links(rows)
    assert collections.Counter((x.doc_id, x.n_shingles, x.component_id) for x in got) == brute_components(rows)
    assert max(v for k, v in made.items() if "cells" not in k) < 12 * 120


def test_intersections_of_many_columns(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, k).astype(np.uint64) << np.uint64(50)) for k in (0, 1, 40, 200, 200, 900)]
    monkeypatch.setattr(neardup, "COLUMNS", 64)
    first, second = np.array([1, 3, 5]), np.array([0, 2, 4])
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in second] for a in first]
    assert neardup.intersections(sets, first, second).tolist() == want


def test_near_dedup_keeps_columns(docs, rows):
    got = neardup.near_dedup(docs)
    assert got.columns == docs.columns
    want = {k: v for k, v in brute_components(rows).items()}
    keep = {c for _, n, c in want if n} | {d for d, n, _ in want if not n}
    kept = [x.doc_id for x in got.collect()]
    assert set(kept) == keep


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert neardup.near_duplicates(empty).count() == 0
    assert dedup.exact_groups(empty).count() == 0 and dedup.exact_dedup(empty).count() == 0
    assert mixing.mix(empty).count() == 0 and packing.pack_pieces(empty).count() == 0
    assert lm.lm_scores(empty).count() == 0 and weaklabels.weak_label_scores(empty).count() == 0
    assert rules.quality_rules(empty, labels).count() == 0
    assert toxicity.score_documents(empty, toxicity.fit(empty, labels), ["doc_id"]).count() == 0
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_dedup(docs, rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    got = dedup.exact_groups(docs).collect()
    assert len(got) == len(rows) and sum(x.kept for x in got) == len(groups)
    want = collections.Counter()
    for r in rows:
        a, none, b = min(groups[norm(r[1])])
        want[(r[0], None if none else b, len(groups[norm(r[1])]))] += 1
    assert collections.Counter((x.doc_id, x.keep_id, x.group_size) for x in got) == want
    left = dedup.exact_dedup(docs)
    assert left.columns == docs.columns and sorted(norm(x.text) for x in left.collect()) == sorted(groups)


def test_packing(docs, rows):
    direct = encoding.Encoder(*encoding.byte_bpe())
    want = collections.Counter()
    for r in rows:
        ids = [*np.frombuffer(direct.direct(r[1] or ""), "<u4"), 1]
        at = 0
        for n in packing.binary_lengths(len(ids), 256):
            want[(r[0], at, n, crc(ids[at : at + n]), len(ids))] += 1
            at += n
        assert at == len(ids)
    got = packing.pack_pieces(docs, most=256).collect()
    assert collections.Counter((x.doc_id, x.start, x.length, x.ids_crc32, x.doc_tokens) for x in got) == want
    assert len({x.sequence_id for x in got}) == len(got) and all(x.length & (x.length - 1) == 0 and x.offset == 0 and zlib.crc32(x.ids) == x.ids_crc32 for x in got)


def brute_targets(sizes):
    """Shares by weight; what is above a cap is dealt again until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, capped = float(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return {**capped, **share}
        for s in over:
            capped[s] = 3.0 * sizes[s]
            left -= capped[s]


def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want, taken = brute_targets(dict(sizes)), collections.Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and math.isclose(x.target, want[x.source], rel_tol=1e-9)
        assert x.taken == x.copies * x.size and x.taken <= 3 * x.size
        taken[x.source] += x.taken
    largest = max(x.size for x in got)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest / 2 + 1, s
    again = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns and out.count() == sum(x.copies for x in got)


def test_mixing_takes_the_smallest_keys(spark):
    rows = [(i, "w " * (i % 7 + 1), "s" if i % 5 else "t") for i in range(500)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()

    def key(x):
        digest = hashlib.md5(f"{x.doc_id}:0".encode()).hexdigest()
        return -math.log((int(digest[:8], 16) + 0.5) / 2**32)

    for s in "st":
        of = sorted((x for x in got if x.source == s), key=key)
        copies = [x.copies for x in of]
        assert copies == sorted(copies, reverse=True) and copies[0] - copies[-1] <= 1


def test_lm_scores(docs, rows):
    texts = [[w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(r[1] or "")] for r in rows]
    uni, bi = collections.Counter(), collections.Counter()
    for t in texts:
        uni.update(t)
        bi.update(zip(t, t[1:]))
    total, want = sum(uni.values()), []
    for r, t in zip(rows, texts, strict=True):
        u, b, s = collections.Counter(t), collections.Counter(zip(t, t[1:])), 0.0
        for i, w in enumerate(t):
            one = max(uni[w] - u[w], 0.5) / (total - len(t))
            pair = (t[i - 1], w) if i else None
            n = bi[pair] - b[pair] if i else 0
            s += math.log(n / (uni[t[i - 1]] - u[t[i - 1]])) if n else math.log(one) + (math.log(0.4) if i else 0)
        want.append((-1 if r[0] is None else r[0], len(t), round(s, 6)))
    got = [(-1 if x.doc_id is None else x.doc_id, x.n_words, round(x.log_score, 6)) for x in lm.lm_scores(docs, 2).collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=1e-5)


def brute_lm(rows, order):
    """(doc_id or -1, n_words, log_score) by stupid backoff over tuples of words, the row's own counts left out."""
    texts = [WORD.findall("".join(c.lower() if c.isascii() else c for c in r[1] or "")) for r in rows]
    grams = lambda t: collections.Counter(tuple(t[i : i + n]) for n in range(1, order + 1) for i in range(len(t) - n + 1))
    everything = sum((grams(t) for t in texts), collections.Counter())
    total, want = sum(map(len, texts)), []
    for r, t in zip(rows, texts, strict=True):
        own = grams(t)
        others = lambda g: everything[g] - own[g]  # noqa: B023, E731
        score = 0.0
        for i, w in enumerate(t):
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(t[i - n + 1 : i + 1])
                if n == 1:
                    score += math.log(max(others((w,)), 0.5) / max(1, total - len(t)))
                elif others(g):
                    score += math.log(others(g) / others(g[:-1]))
                    break
                else:
                    score += math.log(0.4)
        want.append((-1 if r[0] is None else r[0], len(t), score))
    return sorted(want)


@pytest.mark.parametrize("order", [1, 3, 5])
def test_lm_scores_of_other_orders(docs, rows, order):
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.n_words, x.log_score) for x in lm.lm_scores(docs, order).collect())
    for a, b in zip(got, brute_lm(rows, order), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=1e-5)


def test_op4_scores_trigrams(spark, docs, rows, tmp_path):
    """The registered query: longer contexts than the word before count."""
    (tmp_path / "documents.parquet").symlink_to(docs.inputFiles()[0].removeprefix("file:").replace("///", "/").rsplit("/", 1)[0])
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.n_words, x.log_score) for x in queries.op4_lm_scores(spark, str(tmp_path)).collect())
    assert any(abs(a[2] - b[2]) > 0.1 for a, b in zip(brute_lm(rows, 2), brute_lm(rows, 3), strict=True))
    for a, b in zip(got, brute_lm(rows, 3), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=1e-5)


def test_rows_match_when_scans_are_split_differently(spark, docs, rows, monkeypatch):
    """Splits change after every table written, as when executors come or go: what later passes read is still matched."""
    one = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    scores = lambda got: sorted((x.doc_id is None, x.doc_id or 0, x.n_words, round(x.log_score, 6)) for x in got.collect())
    texts = lambda got: collections.Counter((x.doc_id, x.text) for x in got.collect())
    want_scores, want_near, want_mix = scores(lm.lm_scores(docs)), texts(neardup.near_dedup(docs)), texts(mixing.mixed_rows(docs))
    writer, whole = type(docs.write), []
    write = writer.parquet

    def parquet(self, *args, **kwargs):
        write(self, *args, **kwargs)
        for k, v in one.items():
            spark.conf.unset(k) if whole else spark.conf.set(k, v)
        whole.clear() if whole else whole.append(1)

    before = docs.rdd.getNumPartitions()
    monkeypatch.setattr(writer, "parquet", parquet)
    again = lambda: spark.read.parquet(*docs.inputFiles())
    try:
        assert scores(lm.lm_scores(again())) == want_scores
        assert texts(mixing.mixed_rows(again())) == want_mix
        assert texts(neardup.near_dedup(again())) == want_near
        for k, v in one.items():
            spark.conf.set(k, v)
        assert again().rdd.getNumPartitions() < before
    finally:
        for k in one:
            spark.conf.unset(k)


def brute_stats(text):
    words, lines = WORD.findall(text or ""), (text or "").split("\n")
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_text_stats(rows):
    rng = random.Random(1)
    for t in [r[1] for r in rows] + ["".join(rng.choice("ab# \n\t\x1c") for _ in range(rng.randint(0, 80))) for _ in range(500)]:
        assert text_stats(t)[:5] == brute_stats(t), repr(t)


def test_quality_rules(spark, docs, rows):
    labels = spark.createDataFrame([(i * 3 % 1000, 1, 0) for i in range(90)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = rules.quality_rules(docs, labels).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.base_failed == (x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words) and not (x.base_failed and x.kept)


def test_cutoffs_limit_false_rejection():
    assert math.isclose(rules.binomial_tail(2, 10, 0.3), sum(math.comb(10, i) * 0.3**i * 0.7 ** (10 - i) for i in range(3)))
    assert rules.cutoff([0] * 65, 0.01, 0.01) == 65 and rules.cutoff([10] + [0] * 64, 0.01, 0.01) == 65
    rng, wrong = np.random.default_rng(0), 0
    for _ in range(200):  # true rate of a good document beyond step s is 1 - s / 64
        counts = np.bincount(rng.integers(0, 65, 3000), minlength=65).tolist()
        wrong += (65 - rules.cutoff(counts, 0.05, 0.05)) / 65 > 0.05
    assert wrong <= 0.05 * 200 + 6


def test_chat(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|", "a\n<|im_end|>\n", "", None, "<", "|", "ünï\\", "<|<|<\\|"]
    rows = [(c, t, random.Random(c * 50 + t).choice(["user", "assistant", None, "a\n%<|"]), random.Random(c * 99 + t).choice(nasty), "x") for c in range(20) for t in range(9)]
    rows += [rows[0], (None, 1, "user", "no id", "x"), (3, None, "assistant", "no turn", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_chats(df).withColumn("back", chat.read_back(chat.F.col("formatted"))).collect()
    groups = collections.defaultdict(list)
    for c, t, r, x, _ in rows:
        groups[c].append((t is not None, t or 0, r or "", chat_escape(x or ""), x or ""))
    assert {x.conv_id for x in got} == set(groups)
    for x in got:
        want = sorted(groups[x.conv_id])
        assert [(b.role, b.text) for b in x.back] == [(r, t) for *_, r, _, t in want]
        learned = [re.sub(r"<(\\*)\\\|", r"<\1|", x.formatted[s.start : s.start + s.length]) for s in x.loss_spans]
        assert learned == [t for *_, r, _, t in want if r == "assistant"]
        assert x.formatted.count("<|im_start|>") == len(want)


def chat_escape(t):
    return re.sub(r"<(\\*)\|", r"<\1\\|", t)


def test_chat_parts(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    parts = [("text", "see <|image|> ", None, None, None, None, None), ("image", None, "i.png", 56, 57, None, None), None, ("audio", None, "a.wav", None, None, 2.5, None), ("document", None, "d.pdf", None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, content array<{part}>")
    x = chat.format_chats(df, content="content").first()
    assert x.formatted.startswith("<|im_start|>user\nsee <\\|image|> <|image|><|audio|><|document|><|im_end|>\n")
    assert [(a.ref, a.type, a.tokens) for a in x.attachments] == [("i.png", "image", 6), ("a.wav", "audio", 63), ("d.pdf", "document", 1800)] and x.expanded_tokens == 1869


def test_maximal_segments():
    def brute(s, base=0):
        """The best segment, then the same left and right of it."""
        best = max(((sum(s[a:b]), -(b - a), -a) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a, n = -best[2], -best[1]
        return brute(s[:a], base) + [(base + a, base + a + n, best[0])] + brute(s[a + n :], base + a + n)

    rng = random.Random(2)
    for _ in range(300):
        s = [rng.choice([-3, -2, -1, 1, 2, 5]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got, want = toxicity.maximal_segments(np.array(s)), brute(s)
        assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])


def test_logistic_separates():
    """Kinds that are far apart, many rows: the curve crosses between them, whatever the weights."""
    for most in (1, 100, 10_000):
        x = np.array([0, 1, 2, 3, 4, 5, 6, 15, 17, 20, 30, 39], float)
        y = (x > 10).astype(float)
        a, b = toxicity.logistic(x, y, np.where(y > 0, 30.0, 1.0 * most))
        assert 6 < -a / b < 15


def test_slight_odds_do_not_score():
    """A word a little commoner in toxic documents is significant in a large sample and still isn't toxic."""
    assert toxicity.log_odds(np.array([19_000]), np.array([140_000]), 28_000, 244_000)[0] == 0
    assert toxicity.log_odds(np.array([4_000, 24_000]), np.array([300, 240_000]), 28_000, 244_000)[0] > 1


def test_log_odds_take_little_memory(monkeypatch):
    rng = np.random.default_rng(3)
    toxic, clean = rng.integers(0, 40, 1 << 20), rng.integers(0, 400, 1 << 20)
    tracemalloc.start()
    got = toxicity.log_odds(toxic, clean, 3_000, 30_000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got > 0).any() and most < 20 << 20
    monkeypatch.setattr(toxicity, "SLICE", 1 << 20)
    assert (got == toxicity.log_odds(toxic, clean, 3_000, 30_000)).all()


def test_written_tables_leave_no_freed_memory_with_the_driver(spark):
    if not trim_driver(spark):
        pytest.skip("this JVM can't give memory back")
    status = Path(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/status")
    held = lambda: int(re.search(r"RssAnon:\s+(\d+)", status.read_text())[1]) >> 10
    rows = spark.range(10).repartition(2)
    materialize(rows, "first")
    native = [spark._jvm.java.util.zip.Deflater() for _ in range(1500)]
    for x in native[:-1]:  # the last one keeps the memory below it from going by itself
        x.end()
    materialize(rows, "second")
    before = held()
    trim_driver(spark)
    left = before - held()
    native[-1].end()
    assert left < 50


def test_toxicity_sample_drops_near_copies_only(spark):
    """Short texts and texts that share a passage aren't near copies; copies are."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:62]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"bad w{i}" for i in range(20)] + [f"{passage} " + " ".join(f"t{i}_{j}" for j in range(40)) for i in range(40)] + ["the same text twice over again"] * 2
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 1) for i in ids], "doc_id long, quality int, toxic int")
    assert sorted(x.text for x in toxicity.sample(docs, labels).collect()) == sorted(set(texts))


def test_toxicity_held_out(spark, tmp_path):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.2
        words = [f"w{int(rng.paretovariate(0.5)) % 900}" for _ in range(rng.randint(20, 120))]
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [f"bad{rng.choice('abc')}{rng.randrange(30)}" for _ in range(3)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, "")]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    docs, truth = spark.read.parquet(path), {a: c for a, _, c in labels}
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int"))
    got = toxicity.score_documents(docs, model, ["doc_id"], segments=True).collect()
    held = [x for x in got if x.doc_id in truth and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert sum(x.predicted == truth[x.doc_id] for x in held) / len(held) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    clean = toxicity.clean_documents(docs, model)
    assert clean.columns == docs.columns and sorted(x.doc_id for x in clean.collect()) == sorted(x.doc_id for x in got if not x.predicted)


def test_weak_labels(docs, rows):
    v = weaklabels.votes("word " * 5)
    assert weaklabels.unpack(weaklabels.pattern(v)) == list(v)
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    accuracy = np.linspace(0.65, 0.95, len(weaklabels.LABELLERS))
    said = np.where(rng.random((20_000, len(accuracy))) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    said[rng.random(said.shape) < 0.2] = -1
    codes, counts = np.unique([weaklabels.pattern(tuple(x)) for x in said], return_counts=True)
    right, share, _ = weaklabels.expectation_maximisation(codes, counts.astype(float))
    assert abs(share - 0.7) < 0.03 and np.abs(right - accuracy[:, None]).max() < 0.05
    got = weaklabels.weak_label_scores(docs).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and 0 <= x.posterior <= 1 for x in got)
