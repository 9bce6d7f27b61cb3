"""Quality rules, line first: punctuation, navigation and boilerplate rules
judge every line, failing lines go, and a document that loses more than half
of its text is rejected. Built-in expressions only, and no shuffle at all: a
row is judged by itself, in one pass.

The base counts look at the whole text. Repeated 8-word windows are found in
a row by the distinct count of their hashes; only texts that repeat one sort
(hash, hash, position) to find which words are covered, so a text costs
n log n, not n squared.

Defined cases: a null or empty text has no words, fails the base rule and is
not kept; repeated rows are judged alike; an empty table gives an empty
table; further columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import WORD, col, let

RUN = 8  # words of a window
SHORT = 8  # a line of fewer words must end in terminal punctuation
SYMBOLS = r"[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
TERMINALS = ".!?…:;\"”»')]"
NOISE = r"[!?#*$%&<>]{2,}"
BARS = r"[|›•»]"
BOILERPLATE = ("cookie", "javascript", "privacy policy", "terms of use", "terms of service", "all rights reserved",
               "sign in to", "sign up for", "log in to", "subscribe", "lorem ipsum", "{", "}")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def text_lines(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def line_fails(line: Column) -> Column:
    n = F.regexp_count(line, F.lit(WORD))
    last = F.right(F.rtrim(line, F.lit(BLANKS)), F.lit(1))
    unterminated = (F.instr(F.lit(TERMINALS), last) == 0) & (n < SHORT)
    noise, bars = F.regexp_count(line, F.lit(NOISE)), F.regexp_count(line, F.lit(BARS))
    boilerplate = let(F.lower(line), lambda x: reduce(or_, [F.contains(x, F.lit(b)) for b in BOILERPLATE]))
    return (unterminated | ((noise > 0) & (noise * 3 > n)) | ((bars >= 2) & (bars * 5 >= n)) | boilerplate)


def repeat_words(w: Column) -> Column:
    """Words covered by a window that the text holds twice or more."""
    zero = F.lit(0).cast("long")

    def windows(w: Column, key) -> Column:
        """``key`` of the hashes of each window's words, and its place."""
        whole = lambda h: F.slice(F.transform(h, lambda x, i: key(
            [x, *[F.get(h, i + k) for k in range(1, RUN)]], i)), F.lit(1), F.size(h) - (RUN - 1))
        return let(F.transform(w, lambda x: F.xxhash64(x)), whole)

    def same(s: Column, k: Column, other: Column) -> Column:
        x, y = F.get(s, k), F.get(s, other)
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    def repeated(s: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(s, k, k - 1) | same(s, k, k + 1))
        return F.sort_array(F.transform(at, lambda k: F.get(s, k)["at"]))

    def covered(p: Column) -> Column:
        step = lambda k: F.least(F.lit(RUN), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(RUN)))
        return F.when(F.size(p) == 0, zero).otherwise(F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1), zero, lambda acc, k: acc + step(k).cast("long")))

    some = let(windows(w, lambda x, _: F.xxhash64(*x)), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    keyed = F.sort_array(windows(w, lambda x, i: F.struct(
        F.xxhash64(*x).alias("a"), F.hash(*x).alias("b"), i.alias("at"))))
    count = F.when(some, let(let(keyed, repeated), covered)).otherwise(zero)
    return F.when(F.size(w) > RUN, count).otherwise(zero)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base counts, both verdicts and ``clean_text``, the lines that pass."""
    text = F.coalesce(col(text_col), F.lit(""))
    of_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words"))
    of_lines = lambda x: let(F.filter(x, lambda y: ~line_fails(y)), lambda ok: F.struct(
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.char_length(F.array_join(x, "")).alias("chars"),
        F.char_length(F.array_join(ok, "")).alias("left"),
        F.array_join(ok, "\n").alias("clean")))
    rows = docs.select(
        col(id_col).alias("id"), let(words(text), of_words).alias("w"), let(text_lines(text), of_lines).alias("x"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    base = (F.col("w.n_words") < 20) | (100 * F.col("w.n_repeat_words") > 30 * F.col("w.n_words"))
    return rows.select(
        F.col("id").alias(id_col), "w.n_words", "w.word_chars", "n_symbols", "x.n_dup_lines",
        "w.n_repeat_words", base.alias("base_failed"),
        (~base & (2 * F.col("x.left") >= F.col("x.chars"))).alias("kept"), F.col("x.clean").alias("clean_text"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
      FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
c AS (SELECT r, sum(b) AS n_repeat FROM (
        SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS b FROM p) GROUP BY r),
l AS (SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
             len(regexp_extract_all(line, '[|›•»]')) AS bars
      FROM (SELECT r, unnest(string_split(t, E'\n')) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
v AS (SELECT r, count(*) - count(DISTINCT line) AS dup, sum(length(line)) AS chars,
             coalesce(sum(length(line)) FILTER (
               (n < 8 AND NOT contains('.!?…:;"”»'')]', right(rtrim(line, E' \t\n\x0b\x0c\r'), 1)))
               OR len(regexp_extract_all(line, '[!?#*$%&<>]{2,}')) * 3 > n
               OR (bars >= 2 AND bars * 5 >= n)
               OR regexp_matches(lower(line), 'cookie|javascript|privacy policy|terms of use|terms of service|all rights reserved|sign in to|sign up for|log in to|subscribe|lorem ipsum|[{}]')), 0) AS lost
      FROM l GROUP BY r),
a AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(v.dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n_repeat, 0) AS BIGINT) AS n_repeat_words,
             coalesce(v.lost, 0) AS lost, coalesce(v.chars, 0) AS chars
      FROM d LEFT JOIN v USING (r) LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * (chars - lost) >= chars AS kept
FROM a
"""
