import hashlib
import random

import numpy as np
import pytest

from fieldlake.llm import line_chunks, radix_dedup, run_index, simhash
from fieldlake.llm.common import documents

UPPER = {i: i + 32 for i in range(65, 91)}


def pairs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# exact dedup ---------------------------------------------------------------

def test_exact_groups_of_odd_rows(odd):
    got = sorted(tuple(r) for r in radix_dedup.exact_groups(odd).collect() if r.doc_id is not None)
    rows = [(r.doc_id, (r.text or "").translate(UPPER)) for r in odd.collect()]
    want = []
    for i, t in rows:
        ids = [j for j, u in rows if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        if i is not None:
            want.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want)


def test_exact_groups_need_late_bytes(spark):
    base = "x" * 5000
    texts = [base + "a", base + "b", base + "A", "x" * 20, "X" * 20, base[:4990] + "y" + base[:10]] + ["same"] * 300
    got = {r.doc_id: (r.keep_id, r.group_size) for r in radix_dedup.exact_groups(pairs(spark, texts)).collect()}
    assert [got[k] for k in range(6)] == [(2, 2), (1, 1), (2, 2), (4, 2), (4, 2), (5, 1)]
    assert {got[k] for k in range(6, 306)} == {(305, 300)}


def test_exact_groups_of_prefixes_over_all_levels(spark):
    r = random.Random(2)
    base = "".join(r.choice("abcDE ") for _ in range(9000))
    texts = []
    for cut in (0, 1, 15, 16, 17, 255, 256, 257, 4095, 4096, 4097, 8999):  # equal up to one byte, at and around each level
        other = base[:cut] + "#" + base[cut + 1:]
        texts += [other, other.upper(), other[:-1] + "!"]
    texts += [base[:n] for n in (16, 17, 256, 4096, 4097)] * 2
    got = {x.doc_id: (x.keep_id, x.group_size) for x in radix_dedup.exact_groups(pairs(spark, texts)).collect()}
    low = [t.translate(UPPER) for t in texts]
    assert got == {k: (max(j for j, u in enumerate(low) if u == t), low.count(t)) for k, t in enumerate(low)}


def test_exact_groups_of_no_rows(none):
    assert radix_dedup.exact_groups(none).count() == 0


# SimHash -------------------------------------------------------------------

def test_links_join_what_brute_force_joins(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = list(base)
    for f in base:
        for _ in range(12):
            g = f
            for b in r.sample(range(64), r.randrange(1, 5)):
                g ^= 1 << b
            fps.append(g)
    fps = sorted(set(fps) | {0, 7, (1 << 64) - 1})
    df = spark.createDataFrame([(k, simhash.signed(f)) for k, f in enumerate(fps)], "id long, own long")
    got = {r.fp: r.component_id for r in simhash.classes(df, "id", "own").collect()}
    a = np.array(fps, dtype="u8")
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3
    root = np.arange(len(a))
    while True:
        new = np.array([root[near[i]].min() for i in range(len(a))])
        if (new == root).all():
            break
        root = new
    assert [got[simhash.signed(f)] for f in fps] == root.tolist()
    assert len(set(root.tolist())) < len(fps)


def test_dense_tiles_take_no_step_per_pair():
    import time

    r = random.Random(3)
    center = [r.getrandbits(64) for _ in range(3)]
    fps = np.array(sorted({c ^ (1 << i) ^ (1 << j) if i != j else c ^ (1 << i) for c in center for i in range(64) for j in range(64)}),
                   "u8")  # three groups, in which most are within four bits, many within three
    start = time.process_time()
    got = simhash.forest(fps, fps, True, 3)
    other = simhash.forest(fps[::2], fps[1::2], False, 3)
    assert time.process_time() - start < 20 and len(got) == len(fps) - 3 and len(other) <= len(fps)


def test_small_tiles_find_the_same(spark):
    fps = [(1 << k) - 1 for k in range(0, 60)]  # a chain: each within one bit of the next
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    edges = simhash.links(df, tile=2)
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 50)] + [(1000, k) for k in range(1001, 1200)]
    got = dict(simhash.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {got[k] for k in range(51)} == {0} and {got[k] for k in range(1000, 1200)} == {1000}


def brute_fingerprint(text):
    import re

    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_of_odd_rows(odd):
    rows = odd.collect()
    got = simhash.simhash(odd).collect()
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted(
        (r.doc_id or -1, f"{brute_fingerprint(r.text):016x}") for r in rows)
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.component_id for r in got})


def test_simhash_of_no_rows(none):
    assert simhash.simhash(none).count() == 0 and simhash.deduplicated(none).count() == 0


# line chunks ---------------------------------------------------------------

def test_rolling_values_resist_shifts():
    lines = [f"passage line {k}".encode() for k in range(60)]
    own = list(line_chunks.rolled(b"\n".join(lines), 0))
    moved = list(line_chunks.rolled(b"\n".join([b"other", b" "] + lines + [b"more"]), 0))
    assert moved[1:-1] == own and len(own) == 59
    assert list(line_chunks.rolled(b"x\n \n\ny", 0))[0][4] == b" \n\n" and not list(line_chunks.rolled(b"x\n\n", 0))


@pytest.mark.parametrize("clashes", [1, 3])
def test_equal_hashes_are_settled_by_bytes(spark, monkeypatch, clashes):
    """With the first seeds all lines have one hash; the bytes tell, and they are
    hashed anew."""
    rows = [(1, "a a\nb b"), (2, "a a\nb b"), (3, "c c\nd d"), (4, "e e\nf f"), (5, "c c\nd d")]
    real = line_chunks._values, line_chunks._one_line_each
    hashed = line_chunks.line_hash
    seeds = []

    def clashing(line, seed):
        return (1, 2) if seed < clashes else hashed(line, seed)

    def one_each(found, seed):
        line_chunks.line_hash = clashing
        seeds.append(seed)
        return real[1](found, seed)

    # the workers get the functions by value, with the clashing hash in them
    monkeypatch.setattr(line_chunks, "_one_line_each", one_each)
    monkeypatch.setattr(line_chunks, "line_hash", clashing)
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(line_chunks)
    try:
        gone = line_chunks.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(line_chunks)
        line_chunks.line_hash = hashed
    assert seeds == list(range(clashes + 1)) and sorted(r.id for r in gone) == [2, 5]


def brute_runs(rows):
    """Plain search: of each two worded lines in a row that were seen before
    (with the blank lines between), the lines go, but not those of the place seen."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        at, gone = [k for k, x in enumerate(lines) if x.strip()], set()
        for a, b in zip(at, at[1:]):
            d, f = seen.setdefault("\n".join(lines[a:b + 1]), (i, range(a, b + 1)))
            if (d, f[0]) != (i, a):
                gone |= set(range(a, b + 1)) - (set(f) if d == i else set())
        left = [k for k in range(len(lines)) if k not in gone]
        out[i] = "\n".join(lines[k] for k in left) if set(at) & set(left) or not gone else ""
    return out


def planted(sizes=(2, 3, 5, 8, 13, 20), each=6, blank=False):
    """Passages that stand twice, between lines that stand once."""
    r, rows, line = random.Random(4), [], iter(range(10 ** 6))
    own = lambda n: [f"line {next(line)} alone" for _ in range(n)]
    shared = [own(n) for n in sizes for _ in range(each)]
    if blank:
        shared = [[x for y in p for x in (y, "")][:-1] for p in shared]
    for k, p in enumerate(shared * 2):
        rows.append((k, "\n".join(own(r.randrange(1, 9)) + p + own(r.randrange(1, 9)))))
    return rows, shared


def test_every_planted_run_goes(spark):
    rows, shared = planted()
    out, n = line_chunks.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.doc_id: x.text for x in out.collect()}
    for k, p in enumerate(shared):
        assert got[k] == rows[k][1]
        assert got[len(shared) + k] == rows[len(shared) + k][1].replace("\n".join(p) + "\n", "")


def test_runs_as_plain_search(spark):
    r = random.Random(7)
    pool = [f"line {k} w" for k in range(25)] + ["A"] * 4
    rows = [(k, "\n".join(r.choice(pool) for _ in range(r.randrange(12)))) for k in range(200)]
    rows += [(200, "A\nA\nA"), (201, "B\nB\nB\nB"), (202, "C\n\nC\n\nC"), (203, "D\n\nE"), (204, "D\nE")]
    out, n = line_chunks.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.doc_id: x.text for x in out.collect()}
    assert got == brute_runs(rows)
    assert (got[201], got[202], got[204]) == ("B\nB", "C\n\nC", "D\nE")
    lines = lambda texts: {x for t in texts for x in t.split("\n")}
    assert lines(got.values()) == lines(t for _, t in rows)


def test_blank_separated_passages_go(spark):
    rows, shared = planted((2, 3, 8, 40, 400), each=2, blank=True)
    out, n = line_chunks.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.doc_id: x for x in out.collect()}
    for k, p in enumerate(shared):
        assert not set(got[len(shared) + k].text.split("\n")) & {x for x in p if x}
        assert (got[k][n], got[len(shared) + k][n]) == (0, 1)  # a passage is one chunk


def test_runs_of_odd_rows(odd, none):
    out, n = line_chunks.deduplicated(odd)
    assert out.columns == [*odd.columns, n]
    got = {(r.doc_id, r.lang): r for r in out.where("doc_id is not null").collect()}
    assert got[(4, None)].text is None and got[(3, "en")].text == ""
    assert got[(6, None)].text == "" and got[(6, None)][n] == 1 and got[(5, "en")][n] == 0
    assert line_chunks.deduplicated(none)[0].count() == 0


# long repeats --------------------------------------------------------------

def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                hit[p:p + length] = b"\1" * length
            seen.add(b[p:p + length])
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        spans = sum(1 for k in range(len(hit)) if hit[k] and not (k and hit[k - 1]))
        out[i] = (len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return out


def repetitive(seed=3, n=120):
    r = random.Random(seed)
    p = "".join(r.choice("ab ") for _ in range(400))
    return [(k, (r.choice(["", "x" * r.randrange(300), p[r.randrange(200):], "ab" * 150, "é" * r.randrange(200)])
                 + p[r.randrange(300):] + r.choice(["", "y" * 150, p]))[:r.randrange(50, 900)]) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"many": 3}, {"shard": 3000}])
def test_long_repeats_as_brute_force(spark, options):
    rows = [*repetitive(), (1000, None), (1001, "")]
    got = run_index.long_repeats(spark.createDataFrame(rows, "doc_id long, text string"), **options)
    assert {r[0]: tuple(r[1:5]) for r in got.collect()} == brute_repeats(rows)


def test_long_repeats_of_documents(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    want = brute_repeats([tuple(r) for r in docs.collect()])
    assert {r[0]: tuple(r[1:5]) for r in run_index.long_repeats(docs).collect()} == want
    assert sum(v[1] for v in want.values()) > 0


def test_contexts_cross_pieces(monkeypatch):
    text = "".join(random.Random(2).choice("abcd ") for _ in range(5000)).encode()
    whole = run_index.contexts(text)
    monkeypatch.setattr(run_index, "_PIECE", 700)
    parts = run_index.contexts(text)
    assert np.array_equal(np.repeat(whole[0], whole[2]), np.repeat(parts[0], parts[2]))


def test_long_repeats_of_odd_rows(odd, none):
    got = run_index.long_repeats(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id in (3, 4, 5, 6)}
    assert by[3].n_bytes == by[4].n_bytes == 0
    assert by[6].n_removed == by[6].n_bytes == by[5].n_bytes and by[5].n_removed < by[5].n_bytes
    assert run_index.long_repeats(none).count() == 0
