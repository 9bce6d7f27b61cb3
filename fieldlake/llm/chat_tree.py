"""Chat formatting as prefix trees.

Conversations that share their first turns share a path in a tree. A tree is
written as one text, depth first, each shared turn once; every turn carries
its place in that text, the position id of its first character along its own
path, and the intervals of the text it may attend to: those of its ancestors
and its own, joined where one ends as the next begins, so a conversation of
n turns without branches has one interval a turn, not n. Loss intervals mark
the texts of assistant turns. Two prefixes are the same turns if their chained
128-bit digests are equal; their bytes are not compared.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings
inside texts get a backslash behind their first character, one more if they
have some already, so that reading them back is exact.

Sizes: equal conversations are merged first, with map-side partial
aggregation; all their ids meet the one path in a join whose skewed
partitions Spark splits. Conversations are grouped by their first turn; a
first turn shared by more than ``PACK`` characters of different conversations
is written as several trees, split by the second turn and then by the whole
path, each with its own copy of the shared turns, so no task holds more than
about a tree of that size. One conversation is held whole by one task, since
its output is one text.

Defined cases: null texts and roles are empty; turns are ordered by turn
number (null first), then role, then text, and repeated rows are turns of
their own; a null id is a conversation like any other; an empty table gives
an empty table; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import col, pinned

START, END, LEARNT = "<|im_start|>", "<|im_end|>\n", "assistant"
PACK = 250_000  # characters of different conversations in one tree
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_AFTER = {c: "|".join(re.escape(x[1:]) for x in CONTROL if x[0] == c) for c in "<["}
_RAW = re.compile("|".join(f"{re.escape(c)}\\\\*(?:{after})" for c, after in _AFTER.items()))
_ESCAPED = re.compile("|".join(f"{re.escape(c)}\\\\+(?:{after})" for c, after in _AFTER.items()))
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)

TREES = ("tree string, text string, loss array<struct<start:long,stop:long>>, "
         "turns array<struct<start:long,stop:long,parent:int,position:long,attends:array<struct<start:long,stop:long>>>>, "
         "paths array<struct<path:string,leaf:int>>")
READ = "path string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    if "<" not in text and "[" not in text:
        return text
    return _RAW.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    if "<" not in text and "[" not in text:
        return text
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _keys(roles: list[str], texts: list[str]) -> list[str]:
    """A key for each prefix of the conversation."""
    out, so_far = [], b""
    for role, text in zip(roles, texts, strict=True):
        turn = f"{len(role)} {role}{text}".encode("utf-8", "surrogatepass")
        so_far = hashlib.blake2b(so_far + turn, digest_size=16).digest()
        out.append(so_far.hex())
    return out


def _paths(batches):
    for batch in batches:
        keys = [_keys(r, t) for r, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        cols = {"conv": batch.column(0), "roles": batch.column(1), "texts": batch.column(2), "keys": keys,
                "path": [k[-1] for k in keys], "first": [k[0] for k in keys], "second": [k[:2][-1] for k in keys]}
        yield pa.RecordBatch.from_arrays(
            [x if isinstance(x, pa.Array) else pa.array(x) for x in cols.values()], list(cols))


def conversations(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """A row per conversation, with a key for each of its prefixes."""
    turn = F.struct(col("turn").alias("turn"), F.coalesce(col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(col("text"), F.lit("")).alias("text"))
    whole = rows.groupBy(col(id_col).alias("conv")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    kind = rows.schema[id_col].dataType.simpleString()
    return (whole.select("conv", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))
            .mapInArrow(_paths, f"conv {kind}, roles array<string>, texts array<string>, keys array<string>, "
                                "path string, first string, second string"))


def _joined(spans: list[dict], start: int, stop: int) -> list[dict]:
    """The ancestors' intervals and (start, stop) behind them."""
    if spans and spans[-1]["stop"] == start:
        return [*spans[:-1], {"start": spans[-1]["start"], "stop": stop}]
    return [*spans, {"start": start, "stop": stop}]


class _Tree:
    """One tree, written depth first, children in the order of their keys."""

    def __init__(self, convs: pd.DataFrame):
        self.children: dict[str, dict[str, tuple[str, str]]] = {"": {}}
        for keys, roles, texts in zip(convs["keys"], convs["roles"], convs["texts"], strict=True):
            above = ""
            for key, role, text in zip(keys, roles, texts, strict=True):
                self.children.setdefault(above, {})[key] = (role, text)
                above = key

    def write(self) -> tuple[str, list[dict], list[dict], dict[str, int]]:
        parts, loss, turns, at_key, at = [], [], [], {}, 0
        todo = [(k, -1) for k in sorted(self.children[""], reverse=True)]
        said = {k: v for c in self.children.values() for k, v in c.items()}
        while todo:
            key, parent = todo.pop()
            role, text = said[key]
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            stop = at + len(head) + len(body) + len(END)
            up = turns[parent] if parent >= 0 else None
            turns.append({
                "start": at, "stop": stop, "parent": parent,
                "position": up["position"] + up["stop"] - up["start"] if up else 0,
                "attends": _joined(up["attends"] if up else [], at, stop)})
            if role == LEARNT:
                loss.append({"start": at + len(head), "stop": at + len(head) + len(body)})
            parts += [head, body, END]
            at_key[key], at = len(turns) - 1, stop
            todo += [(k, at_key[key]) for k in sorted(self.children.get(key, ()), reverse=True)]
        return "".join(parts), loss, turns, at_key


def _write_tree(convs: pd.DataFrame) -> pd.DataFrame:
    text, loss, turns, at_key = _Tree(convs).write()
    paths = [{"path": p, "leaf": at_key[p]} for p in convs["path"]]
    return pd.DataFrame({"tree": [convs["tree"].iloc[0]], "text": [text], "loss": [loss], "turns": [turns],
                         "paths": [paths]})


def trees(convs: DataFrame, most: int = PACK) -> DataFrame:
    """The trees of the different conversations."""
    one = convs.groupBy("path").agg(F.first(F.struct("first", "second", "keys", "roles", "texts")).alias("c"))
    chars = F.aggregate("c.texts", F.lit(0).cast("long"), lambda n, x: n + F.char_length(x) + 40)
    one = one.select("path", "c.*", chars.alias("chars"))

    def large(key: str, name: str) -> DataFrame:
        return pinned(one.groupBy(F.col(key).alias(f"{name}_key")).agg(F.sum("chars").alias(name))
                      .where(F.col(name) > most))

    firsts, seconds = large("first", "of_first"), large("second", "of_second")
    split = (one.join(firsts, F.col("first") == F.col("of_first_key"), "left")
             .join(seconds, F.col("second") == F.col("of_second_key"), "left"))
    parts = lambda n: F.ceil(2 * F.col(n) / most)
    tree = F.when(F.col("of_first").isNull(), F.col("first")).when(
        F.col("of_second").isNull(),
        F.concat_ws("-", "first", F.pmod(F.xxhash64("second"), parts("of_first")))).otherwise(
        F.concat_ws("-", "second", F.pmod(F.xxhash64("path"), parts("of_second"))))
    return (split.select(tree.alias("tree"), "path", "keys", "roles", "texts")
            .groupBy("tree").applyInPandas(_write_tree, TREES))


def _read(batches):
    """Each path's conversation, read from the text of its tree."""
    for batch in batches:
        for row in batch.to_pylist():
            out = []
            text, turns, loss = row["text"], row["turns"], sorted((x["start"], x["stop"]) for x in row["loss"])
            starts = [a for a, _ in loss]
            for p in row["paths"]:
                whole, learnt = [], hashlib.sha256()
                n_learnt, digest, n = 0, hashlib.sha256(), 0
                for span in turns[p["leaf"]]["attends"]:
                    piece = text[span["start"]:span["stop"]]
                    whole.append(piece)
                    k = _at_or_after(starts, span["start"])
                    while k < len(loss) and loss[k][0] < span["stop"]:
                        said = unescape(text[loss[k][0]:loss[k][1]])
                        learnt.update(said.encode())
                        n_learnt += len(said)
                        k += 1
                formatted = "".join(whole)
                for m in _TURN.finditer(formatted):
                    digest.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                    n += 1
                out.append({"path": p["path"], "n_turns": n, "turns_sha256": digest.hexdigest(),
                            "loss_chars": n_learnt, "loss_sha256": learnt.hexdigest(),
                            "formatted_chars": len(formatted)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("path", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))


def _at_or_after(starts: list[int], x: int) -> int:
    import bisect

    return bisect.bisect_left(starts, x)


def read_back(written: DataFrame) -> DataFrame:
    return written.mapInArrow(_read, READ)


def formatted(rows: DataFrame, id_col: str = "conv_id", most: int = PACK) -> DataFrame:
    """Per conversation what the trees hold of it, read back from them."""
    convs = conversations(rows, id_col)
    back = read_back(trees(convs, most))
    return convs.select(F.col("conv").alias(id_col), "path").join(back, "path").drop("path")
