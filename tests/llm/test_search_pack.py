"""Ranked search, cross-tokenizer alignment and packing, by brute force."""

import hashlib
import math
import os
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from fieldlake.llm import best_fit, cross_align, lexical, registry, subwords
from fieldlake.llm.common import documents

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SPECIAL = "<|endoftext|>"
MARKS = ["a", "b", " ", "  ", "\n", "\t", " ", " ", "　", "é", "漢", "🙂", "'s", "1", SPECIAL, ".", "the", " of",
         "\x85", "\x1c", "\r\n", "<s>", "\x00", "don't", "ß", "​", "ﬁ"]


def odd_texts(n, extra=()):
    r = random.Random(3)
    marks = [*MARKS, *extra]
    return ["".join(r.choice(marks) for _ in range(r.randint(0, 40))) for _ in range(n)] + [
        "", None, " ", "  ", "a ", "a  ", " a", "x" * 5000, " " * 300, "é" * 3000, "word " * 9000, f"{SPECIAL}{SPECIAL}  {SPECIAL} "]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    path, _, model = registry.align_files()
    plain, own = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return plain, own, sentencepiece.SentencePieceProcessor(model_file=model)


# tokens ----------------------------------------------------------------------

def by_units(coder, texts, lead=""):
    import pyarrow as pa

    data, ends = subwords.text_bytes(pa.chunked_array([pa.array(texts, pa.string())]), lead)
    units = subwords.Units(data, ends)
    ids, n = subwords.spread(*coder.words(units.words), units.codes)
    at = np.append(0, np.cumsum(n))[units.bounds]
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_units_give_the_ids_of_whole_texts(libraries, spark, sf):
    plain, own, model = libraries
    texts = odd_texts(2000) + [r.text for r in documents(spark, sf).collect()]
    path, pattern, pieces = registry.align_files()
    got = by_units(subwords.byte_level(path, pattern, False), texts, " ")
    assert got == [plain.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
    got = by_units(subwords.byte_level(path, pattern, True), texts)
    assert got == [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert by_units(subwords.pieces(pieces), texts, " ") == [model.encode(t) if t else [] for t in texts]


# alignment -------------------------------------------------------------------

def tokens_of(libraries, text):
    """Byte strings and ids of both tokenizers, none where the bytes differ."""
    plain, _, model = libraries
    if not text:
        return [], []
    from fieldlake.llm.bpe import byte_characters

    byte_of = {c: b for b, c in enumerate(byte_characters())}
    a = [(i, bytes(byte_of[c] for c in plain.id_to_token(i)) if i != 50256 else SPECIAL.encode())
         for i in plain.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        raw = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        b.append((i, bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def brute_alignment(libraries, rows):
    links, out = {}, []
    for k, (_, text) in enumerate(rows):
        sides = []
        for tokens in tokens_of(libraries, text):
            end, spans = 0, []
            for i, raw in tokens:
                spans.append((end, end + len(raw), i))
                end += len(raw)
            sides.append(spans)
        a, b = sides
        links[k] = [(x, y) for s, e, x in a for t, u, y in b if s < u and t < e] if len(a) < 400 else None
        if links[k] is None:  # the same by a walk, for long texts
            links[k], at = [], 0
            for s, e, x in a:
                while b[at][1] <= s:
                    at += 1
                j = at
                while j < len(b) and b[j][0] < e:
                    links[k].append((x, b[j][2]))
                    j += 1
        shared = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        cut = lambda spans: [[i for _, e, i in spans if lo < e <= hi] for lo, hi in zip([0, *shared], shared)] \
            if len(spans) < 400 else _cut(spans, shared)
        groups = list(zip(cut(a), cut(b)))
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append([len(a), len(b), len(groups), len(links[k]), hashlib.sha256(text.encode()).hexdigest() if a else ""])
    count = Counter(p for x in links.values() for p in x)
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return Counter(
        (key, *facts[:4], sum(count[p] == best[p[1]] for p in links[k]), sum(count[p] for p in links[k]), facts[4])
        for k, ((key, _), facts) in enumerate(zip(rows, out)))


def _cut(spans, shared):
    out, at = [], 0
    for hi in shared:
        group = []
        while at < len(spans) and spans[at][1] <= hi:
            group.append(spans[at][2])
            at += 1
        out.append(group)
    return out


@pytest.mark.parametrize("limit", [subwords.SLICE_BYTES, 2000])
def test_alignment_as_by_brute_force(libraries, spark, sf, limit, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).limit(60).collect()]
    rows += [(1000 + k, t) for k, t in enumerate(odd_texts(150, ["▁", "x▁y"]))]
    rows += [(None, "no id here"), (1, rows[1][1]), (1, rows[1][1]), (2, "other text of an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' as a", "'own' as n_best").repartition(3)
    gather = subwords.gathered
    if limit < subwords.SLICE_BYTES:  # many slices, as on many machines
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        df = df.repartition(20)
    got = cross_align.aligned(df, *registry.align_files())
    assert gather is subwords.gathered
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_alignment(libraries, rows)


def test_alignment_of_nothing(spark, none, odd):
    assert cross_align.aligned(none, *registry.align_files()).count() == 0
    rows = cross_align.aligned(odd.where("coalesce(text, '') = ''"), *registry.align_files()).collect()
    assert rows and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in rows)


# packing ---------------------------------------------------------------------

def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        for room in {c: k for k, c in enumerate(bins) if c + items[at] <= capacity}.values():
            bins[room] += items[at]
            go(at + 1, bins)
            bins[room] -= items[at]
        bins.append(items[at])
        go(at + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def check_placements(counts, capacity):
    rows, n = best_fit.placements(counts, capacity)
    held, seen = defaultdict(list), Counter()
    for length, rank, times, base, offset in rows.tolist():
        assert seen[length] == rank
        seen[length] += times
        for k in range(times):
            held[base + k].append((offset, length))
    assert seen == Counter(counts) and set(held) == set(range(n))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return n


def test_reduction_never_costs_a_sequence():
    r, more, all_fixed = random.Random(1), 0, 0
    for _ in range(600):
        capacity = r.randint(5, 30)
        items = [r.randint(1, capacity) for _ in range(r.randint(1, 10))]
        n, least = check_placements(Counter(items), capacity), fewest(items, capacity)
        plan = best_fit.Plan(Counter(items), capacity)
        best_fit.reduce(plan)
        rest = [x for x, k in plan.left.items() for _ in range(k)]
        assert plan.sequences + (fewest(rest, capacity) if rest else 0) == least
        more, all_fixed = more + (n > least), all_fixed + (not rest)
    assert more <= 3 and all_fixed > 300


def test_plan_does_not_grow_with_the_pieces():
    r = random.Random(2)
    for scale in (10 ** 3, 10 ** 9):
        counts = {n: 1 + int(scale * r.random() ** 3) for n in range(1, 1025)}
        rows, n = best_fit.placements(counts)
        assert len(rows) < 6000 and n <= 1.03 * -(-sum(k * v for k, v in counts.items()) // 1024)


def test_cut():
    assert best_fit.cut(1, 4) == [(0, 1)] and best_fit.cut(4, 4) == [(0, 4)]
    assert best_fit.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and best_fit.cut(8, 4) == [(0, 4), (4, 4)]


def check_packing(rows, texts, own, capacity=1024):
    pieces, held = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for key, text in texts:
        ids = own.encode(text or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(best_fit.cut(len(ids), capacity)):
            want[key].append((k, s, n, zlib.crc32(struct.pack(f"<{n}I", *ids[s:s + n]))))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held), sum(n for v in held.values() for _, n in v)


def test_packed_documents(libraries, spark, sf, odd, none):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    rows += [(10000 + k, t) for k, t in enumerate(odd_texts(100))] + [(r.doc_id, r.text) for r in odd.collect()]
    rows += [(20000 + k, "the same text") for k in range(500)]  # a hot length
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' as length", "'own' as _rank")
    files = registry.align_files()[:2]
    got = best_fit.packed(df, *files).collect()
    n, total = check_packing(got, rows, libraries[1])
    assert n <= 1.05 * math.ceil(total / 1024)
    assert {(r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in got} == {
        (r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in best_fit.packed(df, *files).collect()}
    assert best_fit.packed(none, *files).count() == 0


# ranked search ---------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_search(docs, items, top=50):
    held = [(k, Counter(TERM.findall((t or "").translate(LOWER)))) for k, t in docs]
    lengths = [sum(c.values()) for _, c in held]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in held for t in c)
    terms = defaultdict(set)
    for key, text in items:
        terms[key] |= set(TERM.findall((text or "").translate(LOWER)))
    out = {}
    for key, wanted in terms.items():
        found = []
        for (doc, c), size in zip(held, lengths):
            m = 50 + (50 * size * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in wanted if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out[key] = [(k + 1, None if none else doc, -score) for k, (score, none, doc) in enumerate(sorted(found)[:top])]
    return {k: v for k, v in out.items() if v}


def ranking(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("parts", [1, 7])
def test_search_as_by_brute_force(spark, sf, odd, parts):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf).collect()] + [(r.doc_id, r.text) for r in odd.collect()]
    docs += [(5000 + k, t) for k, t in enumerate(odd_texts(60))] + [(6000 + k, "Équal Ties here") for k in range(80)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(900, docs[3][1][:4000] + " " + docs[5][1]), (901, None), (902, "!?"), (903, "ties HERE ties é"), (903, "équal"),
              (None, "漢 the"), (904, "unheard nowhere")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'own' as score", "'own' as n").repartition(parts)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'own' as doc_id")
    assert ranking(lexical.ranked(df, asked)) == brute_search(docs, items)


def test_search_of_items_in_blocks(spark, sf, monkeypatch):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "ITEM_TERMS", 60)
    monkeypatch.setattr(subwords, "SLICE_BYTES", 4000)
    assert ranking(lexical.ranked(df, asked, top=7)) == brute_search(docs, items, 7)


def test_search_of_nothing(spark, odd, none):
    asked = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert lexical.ranked(none, asked).count() == 0
    assert lexical.ranked(odd, asked.limit(0)).count() == 0
    assert lexical.ranked(odd.where("coalesce(text, '') = ''"), asked).count() == 0


def test_search_holds_one_slice_at_a_time(spark, monkeypatch):
    rows = [(k, f"alpha w{k % 5} filler{k} " * (1_000_000 // 20 + 500 * (k % 3))) for k in range(30)]  # four slices
    items = [(1, "alpha w3"), (2, "w4 filler7 filler8")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kind, seen = type(df), []
    given = kind.mapInArrow

    def one_by_one(self, f, schema, *more, **named):
        if "lexicon" not in self.columns:
            return given(self, f, schema, *more, **named)
        seen.append(self.columns)

        def run(batches):
            def watched():
                for b in batches:
                    assert b.num_rows <= 1, f"{b.num_rows} slices at once"
                    yield b
            yield from f(watched())

        return given(self, run, schema, *more, **named)

    monkeypatch.setattr(kind, "mapInArrow", one_by_one)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranking(lexical.ranked(df, asked, top=9)) == brute_search(rows, items, 9)
    assert len(seen) == 2 and spark.conf.get(name) == before


def test_index_has_a_row_group_per_slice(spark):
    rows = [(k, f"alpha w{k % 5} filler{k} " * (1_000_000 // 20)) for k in range(30)]
    stored = lexical.stored_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in stored.inputFiles()]
    assert sum(m.num_rows for m in groups) == sum(m.num_row_groups for m in groups) >= 3
