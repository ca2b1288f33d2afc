"""Spelling variants, line dedup and the Merkle manifest against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterlake.llm import line_dedup, merkle, registry, spelling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = (", id long, word string, n long, key string, h1 long, shard int, copy int, size long, gone string, `group` string,"
         " node string, tie long, idx long, total long, path string, root string, tail string, mid string")
SPACES = " \t\n\x0b\x0c\r"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def frame(spark, rows, parts=3):
    """Rows with extra columns whose names the operators use themselves."""
    kinds = [c.split()[-1] for c in EXTRA.strip(", ").split(",")]
    fill = tuple(7 if k in ("long", "int") else "z" for k in kinds)
    return spark.createDataFrame([(*r, *fill) for r in rows], DOCS + EXTRA).repartition(parts)


def use(monkeypatch, df):
    monkeypatch.setattr(registry, "table", lambda *a: df)


@pytest.fixture(scope="module")
def whole(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


# --- op11

def _variants(rows):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 5
    v = {w: k for w, k in n.items() if k >= 3}
    near, masked = defaultdict(set), defaultdict(set)
    for w in v:
        for p in range(len(w)):
            masked[w[:p], w[p + 1:]].add(w)
    for (a, b), ws in masked.items():
        ws = ws | ({a + b} & v.keys())
        for w in ws:
            near[w] |= ws - {w}
    best = {w: min(near[w], key=lambda x: (-v[x], x)) for w in v if near[w]}
    form = {w: b for w, b in best.items() if v[b] >= 2 * v[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), k, len(near[w]), v[form[w]] if w in form else None) for w, k in v.items()}


def _odd_words(seed, letters, count):
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randrange(5, 9))) for _ in range(count)]
    words += ["a" * 700, "a" * 701, "b" + "a" * 700, "ÿÀÀÀÀ", "ÿÀÀÀÁ", "ABCDE", "aabbaabb", "aabaabb"]
    pick = lambda: words[int(len(words) * r.random() ** 3)]  # noqa: E731  some words far more often than others
    rows = [(i if i % 7 else None, " ".join([*(pick() for _ in range(300)), *words[-7:]]), None, None, 0) for i in range(40)]
    long = " ".join(pick() for _ in range(20_000))
    return rows + [(1, None, "x", None, None), (2, "", None, "s", 0), (3, "1 2 , abcd", None, None, 0), (50, long, None, None, 0)] + rows[:2]


@pytest.mark.parametrize("most", [256, 6, 1])
def test_variants(spark, most):
    rows = _odd_words(most, "abé", 300)
    got = {tuple(r) for r in spelling.variants(frame(spark, rows), max_list=most).collect()}
    assert got == _variants(rows) and sum(r[4] for r in got) > 500 and any(r[2] not in (r[0], r[1]) for r in got)


def test_variants_whole_table(spark, whole):
    assert {tuple(r) for r in registry.op11_spelling(spark, SF).collect()} == _variants(whole)


def test_lists_are_bounded(spark):
    words = [f"prefix{a}{b}{c}suffix" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    sizes = spelling.lists(df, 20).groupBy("long_len", "lo", "hi", "key").count().filter("hi - lo > 1")
    assert sizes.agg({"count": "max"}).first()[0] <= 20
    near = spelling.near_words(df, 20).collect()
    assert len(near) == 1000 and {r["n_near"] for r in near} == {27}


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}" if i < 100 else None) for i in range(101)]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {(r["word"], r["root"]) for r in got} == {(w, "w100") for w, f in chain if f}


# --- op12

def _stripped(rows, least=40, docs=5):
    def key(x):
        k = lower(x.strip(SPACES))
        return k if len(k) >= least else None

    holders = defaultdict(list)
    for i, t, *_ in rows:
        for k in {key(x) for x in (t or "").split("\n")} - {None}:
            holders[k].append(-1 << 63 if i is None else i)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), i) in (i, -1 << 63 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def _shared_lines():
    r = random.Random(5)
    common = [f"  This line number {i} stands in very many documents, ä {i} times  " for i in range(30)]
    rows = []
    for i in range(120):
        own = [f"an own line of document {i} that nothing else holds {r.random()}" for _ in range(3)]
        lines = own + r.sample(common, 6) + ["short", "", "\t" + common[0].upper().strip() + "\r", common[0]]
        r.shuffle(lines)
        rows.append((i % 100 if i % 11 else None, "\n".join(lines), "en", "s", 1))
    rows += [(500, None, None, None, None), (501, "", None, None, 0), (502, "\n", None, None, 0), (502, "\n" + common[1] * 2_000, None, None, 0)]
    only_null = [(None, "a line that only rows without an id hold, six times", None, None, 0)] * 6
    tied = [(900, f"{i}\nthis line has its largest id on more than one row here", None, None, 0) for i in range(5)]
    return rows + only_null + tied + [(7, "x\nthis line has its largest id on more than one row here", None, None, 0)]


@pytest.mark.parametrize("shard_keys,probes", [(50_000, 50_000), (4, 20)])
def test_line_dedup(spark, shard_keys, probes):
    rows = _shared_lines()
    got = line_dedup.dedup_lines(frame(spark, rows), shard_keys=shard_keys, probes=probes).selectExpr(
        "id", "n_lines", "n_dropped", "sha2(kept, 256)").collect()
    want = _stripped(rows)
    assert sorted((tuple(r) for r in got), key=str) == want and sum(r[2] for r in want) > 300


def test_line_dedup_without_common_lines(spark):
    rows = [(i, f"line {i} of a table in which no line is repeated at all\nshort", None, None, 0) for i in range(9)]
    got = line_dedup.dedup_lines(frame(spark, rows)).selectExpr("id", "n_lines", "n_dropped", "sha2(kept, 256)").collect()
    assert sorted((tuple(r) for r in got), key=str) == _stripped(rows)


def test_line_dedup_of_short_lines_only(spark):
    """Whether a line is long enough is seen at run time only."""
    rows = [(i, "short\n" * (i % 3), None, None, 0) for i in range(40)]
    got = line_dedup.dedup_lines(frame(spark, rows)).selectExpr("id", "n_lines", "n_dropped", "sha2(kept, 256)").collect()
    assert sorted((tuple(r) for r in got), key=str) == _stripped(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_minimal_perfect_hash(n):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
    h = line_dedup.MinimalPerfectHash.from_bytes(line_dedup.MinimalPerfectHash.build(keys).to_bytes())
    assert sorted(h.index(keys)) == list(range(len(keys)))
    assert (h.index(r.integers(0, 1 << 63, 100, dtype=np.uint64)) < max(1, len(keys))).all()


def test_keys_that_share_64_bits_are_told_apart(spark):
    import pandas as pd
    counts = spark.createDataFrame([(5, 1, 10, 100), (5, 2, 20, 200), (6, 1, 30, 300)], "h1 long, h2 long, docs long, keeper long")
    index = line_dedup.build_index(counts, 1).toPandas()
    assert isinstance(index, pd.DataFrame)
    n, keeper = line_dedup.probe(index, np.array([5, 5, 6, 5, 7]), np.array([1, 2, 1, 3, 1]))
    assert n.tolist() == [10, 20, 30, 0, 0] and keeper.tolist() == [100, 200, 300, 0, 0]


# --- op13

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(i, text, lang, source, n):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def _tree(nodes):
    """(root, siblings of every node level by level)."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append((run[:i % 3], run[i % 3 + 1:]))
        nodes, at = [_h(*nodes[j:j + 3]) for j in range(0, len(nodes), 3)], [i // 3 for i in at]
    return nodes[0], paths


def _audit(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees, ordered = {}, {}
    for s in names:
        ordered[s] = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        trees[s] = _tree([_leaf(*r) for r in ordered[s]])
    root, above = _tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for r, path in zip(ordered[s], trees[s][1]):
            i, text, lang, source, n = r
            bad = text is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0
            acc = _leaf(i, text.replace("\n", "") if bad else text, lang, source, n)
            for left, right in path + up:
                acc = _h(*left, acc, *right)
            out.append((i, _leaf(*r), trees[s][0], root, _h(*(x for a, b in path + up for x in a + b)), acc, acc == root))
    return sorted(out, key=str)


def _manifest_rows():
    r = random.Random(9)
    rows = [(r.randrange(400) if i % 9 else None, f"text {i % 40}\nline ü" if i % 5 else None, [None, "en", "dé"][i % 3],
             None if i % 2 else f"s{i % 7}", i if i % 4 else None) for i in range(500)]
    return rows + rows[:40] + [(1, "alone\n", None, "zz", 0), (2, "", "", "", 0), (3, "x\n" * 50_000, None, "Ä", 1), (-5, "\n", None, "s1", 1)]


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_merkle(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    rows = _manifest_rows()
    use(monkeypatch, frame(spark, rows))
    got = sorted((tuple(r) for r in registry.op13_merkle(spark, "").collect()), key=str)
    assert got == _audit(rows) and {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 3, 4, 243, 244])
def test_merkle_of_one_source(spark, monkeypatch, count):
    rows = [(i, "a\nb", "en", "s", 3) for i in range(count)]
    use(monkeypatch, frame(spark, rows))
    assert sorted((tuple(r) for r in registry.op13_merkle(spark, "").collect()), key=str) == _audit(rows)
