"""Token ids of many texts at once, through the distinct units of a slice.

A slice is some megabytes of whole texts. Its texts are cut into units before
every space that follows a character which is no white space; at such a place
neither tokenizer below can hold a token across the cut, so the ids of a text
are those of its units in order. Each distinct unit of a slice is encoded once
and the ids are gathered for all texts by numpy.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fieldlake.llm.bpe import byte_characters
from fieldlake.llm.common import slices

SLICE_BYTES = 8 << 20  # of text in a slice; a longer text is a slice of its own


def gathered(batches, at: int, most: int = SLICE_BYTES) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of about ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for one in slices(batch, at, most):
            n = pc.sum(pc.binary_length(one.column(at))).as_py() or 0
            if held and size + n > most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(one)
            size += n
    if held:
        yield pa.Table.from_batches(held)


def text_bytes(column: pa.ChunkedArray, lead: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and where each one starts,
    with the end of the last. ``lead`` goes before each text that has any."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if lead:
        has = pc.greater(pc.binary_length(texts), 0)
        lead, none = (pa.scalar(x, pa.large_string()) for x in (lead, ""))
        texts = pc.if_else(has, pc.binary_join_element_wise(lead, texts, none), texts)
    texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, "<i8")[texts.offset:texts.offset + len(texts) + 1] if ends else np.zeros(1, "<i8")
    data = np.frombuffer(data, "u1") if data else np.zeros(0, "u1")
    return data[ends[0]:ends[-1]], ends - ends[0]


# Leading bytes of the three-byte characters among which there is white space.
WIDE_SPACES = np.array([0xE19A, 0xE280, 0xE281, 0xE380])


def ends_solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place ``at`` (> 0) is
    surely no white space."""
    last = data[at - 1]
    solid = last > 0x20
    wide = np.flatnonzero(last >= 0x80)
    before = data[np.maximum(at[wide] - 2, 0)]
    two = (before == 0xC2) & np.isin(last[wide], (0x85, 0xA0))
    three = np.isin(data[np.maximum(at[wide] - 3, 0)].astype("i4") << 8 | before, WIDE_SPACES)
    solid[wide] = ~(two | three)
    return solid


class Units:
    """The texts of a slice as units: ``words`` are the distinct ones (bytes),
    ``codes`` numbers the units of all texts in order and ``bounds`` says where
    the units of each text start."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        at = np.flatnonzero(data == 0x20)
        at = at[at > 0]
        starts = np.union1d(ends[:-1][np.diff(ends) > 0], at[ends_solid(data, at)])
        bounds = np.append(starts, len(data)).astype("<i8")
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        self.codes = units.indices.to_numpy()
        self.words: list[bytes] = units.dictionary.to_pylist()
        self.bounds = np.searchsorted(starts, ends)


def spread(items: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of list ``c`` for each ``c`` of ``codes``, one after another,
    and the number of each."""
    starts = np.cumsum(counts) - counts
    n = counts[codes]
    total = int(n.sum())
    at = np.arange(total) + np.repeat(starts[codes] - (np.cumsum(n) - n), n)
    return items[at], n


def encoded_words(words: list[bytes], joined: Callable[[list[bytes]], list], single: Callable[[bytes], list],
                  sizes: np.ndarray, part: int = 65536) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word and their numbers. Words that begin with a space and
    end solid are encoded many in one text, where their ends are ends of
    tokens; the others one by one."""
    n = np.fromiter(map(len, words), "<i8", len(words))
    data = np.frombuffer(b"".join(words), "u1")
    stops = np.cumsum(n)
    plain = np.flatnonzero((data[stops - n] == 0x20) & ends_solid(data, stops)) if len(words) else np.zeros(0, "i8")
    held, order, counts = [], [], []  # ids, of which words, and how many each
    part_of = np.cumsum(n[plain]) // part
    cuts = [0, *(np.flatnonzero(np.diff(part_of)) + 1).tolist(), len(plain)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        group = plain[a:b]
        ids = np.asarray(joined([words[i] for i in group.tolist()]), "<i4")
        token_ends, word_ends = np.cumsum(sizes[ids]), np.cumsum(n[group])
        at = np.searchsorted(token_ends, word_ends)
        if len(at) and at[-1] < len(token_ends) and (token_ends[at] == word_ends).all():
            held.append(ids)
            order.append(group)
            counts.append(np.diff(at + 1, prepend=0))
    rest = np.ones(len(words), bool)
    for group in order:
        rest[group] = False
    others = np.flatnonzero(rest)
    lists = [np.asarray(single(words[i]), "<i4") for i in others.tolist()]
    held, order, counts = [*held, *lists], [*order, others], [*counts, np.fromiter(map(len, lists), "<i8", len(lists))]
    place = np.empty(len(words), "<i8")
    place[np.concatenate(order)] = np.arange(len(words))
    return spread(np.concatenate([*held, np.zeros(0, "<i4")]), np.concatenate(counts), place)


def table_of(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings end to end, and their sizes."""
    return np.frombuffer(b"".join(entries), "u1"), np.fromiter(map(len, entries), "<i8", len(entries))


class ByteLevel:
    """The byte-level tokenizer of a ``tokenizers`` file. Its merges are
    numbered like its ids, so they are ranks, and a rank encoder gives the same
    ids; words with the text of an added token go to the tokenizer itself if
    ``special`` (then that text is its one id), else they are plain text."""

    def __init__(self, path: str, pattern: str, special: bool):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, p)): i for p, i in vocabulary.items() if p not in added}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if merged != list(range(256, 256 + len(merged))):
            raise ValueError("the ids of this tokenizer do not follow its merges")
        bytes_of = {i: p for p, i in ranks.items()} | {i: t.encode() for t, i in added.items()}
        self.flat, self.sizes = table_of([bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)])
        self.added = [t.encode() for t in added] if special else []
        self.ranked = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _one(self, word: bytes) -> list[int]:
        text = word.decode()
        if any(t in word for t in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def _many(self, words: list[bytes]) -> list[int]:
        text = b"".join(words)
        if any(t in text for t in self.added):
            return []  # one by one
        return self.ranked.encode_ordinary(text.decode())

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return encoded_words(words, self._many, self._one, self.sizes)


class Pieces:
    """A sentencepiece model that adds a space before the text and has no
    piece with a space after another character, so no token spans a cut."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        if any(a != "▁" and b == "▁" for p in names for a, b in zip(p, p[1:], strict=False)):
            raise ValueError("this model has pieces that span a space")
        self.bytes_of = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(names)]
        self.flat, self.sizes = table_of(self.bytes_of)

    def _one(self, word: bytes) -> list[int]:
        text = word[1:].decode()  # the first space is the one that is added
        return self.model.encode(text, num_threads=1) if text else [self.model.piece_to_id("▁")]

    def _many(self, words: list[bytes]) -> list[int]:
        ids = self._one(b"".join(words))
        return ids if b"".join(map(self.bytes_of.__getitem__, ids)) == b"".join(words) else []

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return encoded_words(words, self._many, self._one, self.sizes, part=16384)


@functools.lru_cache(maxsize=4)
def byte_level(path: str, pattern: str, special: bool) -> ByteLevel:
    return ByteLevel(path, pattern, special)


@functools.lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)
