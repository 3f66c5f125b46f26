"""Byte-level BPE ids of many texts at once, by the tokenizers library.

A single space between two other characters always begins a piece of byte-level BPE's
splitting pattern, and merges never cross pieces; a single line end is a piece of its own, as
is a comma or full stop between a letter and a space. So a text may be cut at such places.
The texts of an Arrow batch are cut together, equal chunks become one dictionary entry,
only entries not met before go to the tokenizer, many in one call, and the ids of all texts
are gathered in numpy. Chunks of letters are one piece each and go to the tokenizer's model
without its pattern. Texts with other white space around a space, of unusual characters or
with special tokens go to the tokenizer whole; so every text has the ids that it gives it.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import SparkSession

#: Texts that match are not cut: characters beyond plain Latin and Cyrillic, tabs and returns,
#: white space beside a space, a space at either end.
WHOLE = r"[^\n\x20-\x7e\x{a1}-\x{2af}\x{400}-\x{481}]|  |\n | \n|^ | $"
#: A comma or full stop after anything but a letter belongs to a piece with what stands before it.
MIXED = r"(^|[^\pL])[.,] "
#: Marks a chunk that has no space before it; no text that is cut holds this character.
BARE = "\x01"
#: The byte-level sign of a space at the start of a token.
SPACE = "Ġ"
#: Byte-level BPE writes bytes as characters: those of Latin-1 that print stand for themselves,
#: the others follow from 256 in order.
PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = np.arange(256, dtype="<u4")
BYTE_SIGNS[[b for b in range(256) if b not in PRINTED]] = 256 + np.arange(256 - len(PRINTED))
BYTE_SIGNS[ord("\n")] = ord("\n")     # here it parts the pieces


class Memory:
    """Ids of chunks: their names, and one growing array of ids."""

    def __init__(self):
        import pyarrow as pa
        self.names = pa.array([], pa.large_string())
        self.ids = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1, np.int64)     # entry i holds ids bounds[i]..bounds[i + 1]

    def find(self, chunks) -> np.ndarray:
        """Entry numbers, -1 for chunks not kept."""
        import pyarrow.compute as pc
        return pc.fill_null(pc.index_in(chunks, value_set=self.names), -1).to_numpy().astype(np.int64)

    def add(self, chunks, ids: np.ndarray, lengths: np.ndarray) -> None:
        import pyarrow as pa
        used = int(self.bounds[-1])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used:used + len(ids)] = ids
        self.bounds = np.concatenate([self.bounds, used + np.cumsum(lengths)])
        self.names = pa.concat_arrays([self.names, chunks])

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries one after another, and how many each has."""
        start = self.bounds[entries]
        lengths = self.bounds[entries + 1] - start
        total = int(lengths.sum())
        small = np.int32 if max(total, len(self.ids)) < 1 << 31 else np.int64
        place = np.arange(total, dtype=small)
        place += np.repeat((start - (np.cumsum(lengths) - lengths)).astype(small), lengths)
        return self.ids[place], lengths


class PieceEncoder:
    """The tokenizer, with the ids of chunks it has met kept.

    Memory holds two generations of about ``limit`` chunks: what is not met while that many
    new ones come is forgotten. Chunks with no space before them are kept under a leading mark.
    """

    def __init__(self, tokenizer: str, limit: int = 300_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.limit = limit
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.pieces = Tokenizer.from_str(tokenizer)
        self.pieces.pre_tokenizer = CharDelimiterSplit("\n")
        self.young, self.old = Memory(), Memory()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, chunks, letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks with a space before them, and how many each has: a token that begins with the space begins a chunk."""
        text = " " + ("\n " if letters else " ").join(chunks.to_pylist())
        if letters:
            signs = BYTE_SIGNS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(self.pieces.encode_batch_fast([signs], add_special_tokens=False)[0].ids, np.uint32)
        else:
            (ids,) = self._whole([text])
        lengths = np.diff(np.flatnonzero(self.spaced[ids]), append=len(ids))
        if len(lengths) != len(chunks):
            raise RuntimeError("chunks and the tokens that begin them differ in number")
        return ids, lengths

    def _learn(self, chunks) -> np.ndarray:
        """Keep the ids of chunks that are new to both generations; their entry numbers."""
        import pyarrow as pa
        import pyarrow.compute as pc
        letters = pc.utf8_is_alpha(chunks).to_numpy(zero_copy_only=False)
        bare = pc.starts_with(chunks, BARE).to_numpy(zero_copy_only=False)
        out = np.empty(len(chunks), np.int64)
        for kind, mask in (("letters", letters), ("bare", bare), ("mixed", ~letters & ~bare)):
            at = np.flatnonzero(mask)
            for i in range(0, len(at), 20_000):
                own = at[i:i + 20_000]
                part = chunks.take(pa.array(own))
                if kind == "bare":
                    each = self._whole([c[1:] for c in part.to_pylist()])
                    ids, lengths = np.concatenate(each), np.array([len(x) for x in each])
                else:
                    ids, lengths = self._spaced(part, kind == "letters")
                out[own] = len(self.young.names) + np.arange(len(own))
                self.young.add(part, ids, lengths)
        return out

    def _entries(self, chunks) -> np.ndarray:
        """Entry numbers, in the young generation, of distinct chunks."""
        import pyarrow as pa
        if len(self.young.names) >= self.limit:
            self.young, self.old = Memory(), self.young
        found = self.young.find(chunks)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            names = chunks.take(pa.array(missing))
            before = self.old.find(names)
            again = before >= 0
            found[missing[again]] = len(self.young.names) + np.arange(int(again.sum()))
            self.young.add(names.filter(pa.array(again)), *self.old.gather(before[again]))
            found[missing[~again]] = self._learn(names.filter(pa.array(~again)))
        return found

    def encode_all(self, texts) -> list[np.ndarray]:
        """The ids of each text of an Arrow string array; null has none."""
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, WHOLE)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        odd = odd.to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i, t in zip(np.flatnonzero(odd).tolist(), texts.filter(pa.array(odd)).to_pylist()):
            out[i], = self._whole([t])
        even = np.flatnonzero(~odd & ~empty)
        if not len(even):
            return out
        cut = texts.take(pa.array(even)) if len(even) < len(texts) else texts
        cut = pc.if_else(pc.match_substring(cut, "\n\n"), cut, pc.replace_substring(cut, "\n", f" {BARE}\n {BARE}"))
        plain = pc.invert(pc.match_substring_regex(cut, MIXED))
        for sign in ",.":
            cut = pc.if_else(plain, pc.replace_substring(cut, f"{sign} ", f" {BARE}{sign} "), cut)
        lists = pc.split_pattern(cut, " ")
        flat = lists.flatten()
        begin = np.asarray(lists.offsets)[:-1] - np.asarray(lists.offsets)[0]
        none, bare = pa.scalar("", flat.type), pa.scalar(BARE, flat.type)
        first = pc.binary_join_element_wise(none, flat.take(pa.array(begin)), bare)
        both = pa.concat_arrays([flat, first]).dictionary_encode()
        codes = np.asarray(both.indices)    # after the chunks, the first ones again with their mark
        at = codes[:len(flat)].copy()
        at[begin] = codes[len(flat):]
        used = np.bincount(at, minlength=len(both.dictionary)) > 0
        entry = np.full(len(both.dictionary), -1)
        entry[used] = self._entries(both.dictionary.filter(pa.array(used)))
        ids, lengths = self.young.gather(entry[at])
        ends = np.cumsum(np.add.reduceat(lengths, begin)).tolist()
        for i, a, b in zip(even.tolist(), [0, *ends], ends):
            out[i] = ids[a:b]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        import pyarrow as pa
        return self.encode_all(pa.array([text], pa.string()))[0]


@lru_cache(1)
def encoder(tokenizer: str) -> PieceEncoder:
    """One encoder per Python worker, which keeps what it has met from task to task."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return PieceEncoder(tokenizer)


def ship(spark: SparkSession, path: str):
    """The tokenizer file, read where the driver runs, for all executors: a file of a few MB, whatever the data."""
    return spark.sparkContext.broadcast(Path(path).read_text())


def end_each(texts: Iterable[np.ndarray], end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each closed by the end id, and each text's count."""
    end = np.array([end_id], np.uint32)
    parts = [x for t in texts for x in (t, end)]
    lengths = np.array([len(x) + 1 for x in parts[::2]], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), lengths
