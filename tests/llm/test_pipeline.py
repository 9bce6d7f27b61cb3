"""Each stage of the pipeline against brute force on a small table; only the
trained network's scores are taken as given."""

import base64
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from fieldlake.llm import mixing, registry, toxic_gru
from test_dedup import brute_fingerprint, brute_runs

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    r = random.Random(9)
    words = [f"{a}{b}" for a in ("ba", "ko", "li", "mu", "ne") for b in ("r", "st", "nd", "lm", "x", "p", "gg")]
    line = lambda n=9: " ".join(r.choice(words) for _ in range(n))
    passages = [[line() for _ in range(n)] for n in (2, 3, 6, 12)]
    texts = []
    for k in range(70):
        lines = [line() for _ in range(r.randrange(2, 9))]
        if k % 3 == 0:
            at = r.randrange(len(lines))
            lines[at:at] = r.choice(passages)
        if k % 7 == 3:
            lines[-1] = "vile awful scum " * 3
        texts.append("\n".join(lines))
    long = [line(200) for _ in range(6)]  # one line each: line dedup leaves them
    texts += [*long, *(x + " end" for x in long), *texts[:4], *long[:2]]
    return [(k, t, "en", ("a", "b", "c", None)[k * k % 7 % 4], len(t)) for k, t in enumerate(texts)]


def network(rows):
    known = [(t, float("vile" in t)) for _, t, *_ in rows]
    return toxic_gru.train([t for t, _ in known], np.array([y for _, y in known]), rounds=30)


def brute_near(rows):
    fps = [int(brute_fingerprint(t)) for _, t, *_ in rows]
    root = list(range(len(rows)))
    for _ in rows:
        new = [min(root[j] for j, g in enumerate(fps) if (f ^ g).bit_count() <= 3) for f in fps]
        if new == root:
            break
        root = new
    least = {}
    for row, g in zip(rows, root, strict=True):
        least[g] = min(least.get(g, row), row, key=lambda x: x[0])
    return sorted(least.values())


def brute_mix(rows):
    """Times each row with a word is taken, by the mix's SQL."""
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=COLUMNS)[["doc_id", "text", "source"]])
    return {i: taken // size for i, size, taken in
            con.sql(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE})").fetchall() if size}


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    path, pattern = registry.bpe_files()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_stages_as_brute_force(spark, sf, monkeypatch, reference):
    rows = corpus()
    net = network(rows)
    monkeypatch.setattr(registry, "toxic_network", lambda *_: net)
    stages, key = dict(corpus_pipeline.STAGES), lambda x: x[0]

    def through(name, table):
        df = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
        return sorted((tuple(x) for x in stages[name](spark, df, sf).collect()), key=key)

    score = toxic_gru._score(net, [t for _, t, *_ in rows])
    clean = through("toxicity", rows)
    assert clean == [x for x, s in zip(rows, score, strict=True) if s < 0.7] and 0 < len(clean) < len(rows)

    left = brute_runs([x[:2] for x in clean])
    deduped = through("line_dedup", clean)
    assert deduped == [(i, left[i], a, b, len(left[i])) for i, _, a, b, _ in clean]
    assert sum(x != y for x, y in zip(clean, deduped, strict=True)) > 10

    one_each = through("near_dedup", deduped)
    assert one_each == brute_near(deduped) and len(one_each) <= len(deduped) - 6

    mixed, times = through("mix", one_each), brute_mix(one_each)
    assert Counter(x for x in mixed if x[1].strip()) == Counter(
        {x: times[x[0]] for x in one_each if times.get(x[0])})
    assert len(set(times.values())) > 1

    ids = through("encode", mixed)
    assert [x[0] for x in ids] == [x[0] for x in mixed]
    texts = {x[0]: x[1] for x in mixed}
    assert all(list(x[-1]) == reference.encode_ordinary(texts[x[0]]) for x in ids)
