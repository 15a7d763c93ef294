"""Token ids of a public tokenizer, for Arrow batches of texts.

Texts are cut at spaces where the tokenizer never joins what stands on either side. Each
distinct chunk is encoded once per worker (a bounded memory) and the ids are gathered
with array operations, which gives the same ids as encoding the whole texts. Remembered
chunks are one Arrow array: a Python string and a dictionary entry for each would take
several times its memory, in every worker and until it ends.

Where the vocabulary drops white space and case, texts are first cut finer: lines end, and
a punctuation mark after a letter begins, a chunk. Many fewer chunks are distinct then.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks remembered by a worker, bytes of text handled at once, and chunks that the
#: tokenizer gets in one call.
REMEMBERED, AT_ONCE, A_CALL = 400_000, 4 << 20, 10_000
_MARK = "\x01"
#: Texts left as they are: lowering a letter before a combining mark can change what the
#: two compose to, and a special token must stay in one piece.
_UNTOUCHED = r"\pM|<\|"
#: Where a word ends for every vocabulary of the second kind.
_WORD_END = r"(\pL)([.,;:!?)\]])"
#: Words that normalization leaves as they are: lower-case letters of two Unicode blocks.
_LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_PLAIN_WORD = re.compile(f"[{_LETTERS}]+").fullmatch
_encoders: dict[str, "ChunkEncoder"] = {}


def encoder(file: str) -> "ChunkEncoder":
    """The worker's encoder for a vocabulary file of the public tokenizers."""
    if file not in _encoders:
        _encoders[file] = ChunkEncoder(file)
    return _encoders[file]


class ChunkEncoder:
    """Encodes by chunks. Two kinds of vocabulary are known: those in which a word keeps the
    one space before it (byte level), and those that drop white space (word ends)."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        self.spaced = bool(self._plain([" "])[0])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        if self.spaced:
            space = "Ġ"  # the byte-level letter for a space
            self.first_ids = np.array(sorted(i for t, i in vocabulary.items() if t[0] == space))
        else:
            self.mark_id = self._plain([_MARK])[0][0]
        # Whether case is dropped and marks end words, as the finer cuts need.
        self.folded = not self.spaced and self._plain(["A, a"]) == self._plain(["a , a"])
        if self.folded:
            self.tokenize = self.tokenizer.model.tokenize
            self.letters = str.maketrans({x: self.tokenizer.pre_tokenizer.pre_tokenize_str(x)[0][0] for x in _LETTERS})
        self.known = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, end to end, and the count of each."""
        if len(chunks) > A_CALL:
            parts = [self._encode_chunks(chunks[i : i + A_CALL]) for i in range(0, len(chunks), A_CALL)]
            return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])
        if not self.folded:
            return self._encode_joined(chunks)
        # What normalization would leave as it is goes straight to the model.
        plain = np.fromiter((_PLAIN_WORD(x) is not None for x in chunks), bool, len(chunks))
        words = [[t.id for t in self.tokenize(x.translate(self.letters))] for x, own in zip(chunks, plain) if own]
        others, sizes = self._encode_joined([x for x, own in zip(chunks, plain) if not own])
        counts = np.empty(len(chunks), np.int64)
        counts[plain], counts[~plain] = [len(x) for x in words], sizes
        ids, ours = np.empty(int(counts.sum()), np.uint32), np.repeat(plain, counts)
        ids[ours] = np.fromiter((i for x in words for i in x), np.uint32, int(ours.sum()))
        ids[~ours] = others
        return ids, counts

    def _encode_joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by one call of the tokenizer for all chunks."""
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.spaced:
            ids = np.array(self._plain([" " + " ".join(chunks)])[0], np.uint32)
            begins = np.flatnonzero(np.isin(ids, self.first_ids))
        else:
            ids = np.array(self._plain([f" {_MARK} ".join(["", *chunks])])[0], np.uint32)
            marks = np.flatnonzero(ids == self.mark_id)
            begins = marks - np.arange(len(marks))
            ids = np.delete(ids, marks)
        if len(begins) == len(chunks):
            return ids, np.diff(np.append(begins, len(ids)))
        lists = self._plain([" " + x for x in chunks] if self.spaced else chunks)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum())), counts

    def _lookup(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids table, and per chunk its start and count in that table."""
        place = pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(place < 0)
        new = chunks.take(pa.array(missing))
        ids, counts = self._encode_chunks(new.to_pylist())
        room = max(0, REMEMBERED - len(self.known))
        if room:
            kept = min(room, len(new))
            self.known = pa.concat_arrays([self.known, new.slice(0, kept)])
            self.ids = np.concatenate([self.ids, ids[: int(counts[:kept].sum())]])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts[:kept])])
        table = np.concatenate([self.ids, ids])
        start, count = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        found = np.flatnonzero(place >= 0)
        start[found] = self.starts[place[found]]
        count[found] = self.starts[place[found] + 1] - start[found]
        start[missing] = len(self.ids) + np.cumsum(counts) - counts
        count[missing] = counts
        return table, start, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end (uint32), and the count of each. Null is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        groups = np.cumsum(sizes) // AT_ONCE if len(sizes) else np.zeros(0, np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1), len(texts)]
        parts = [self._encode(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:]) if b > a]
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.folded:
            finer = pc.replace_substring_regex(pc.replace_substring(pc.ascii_lower(texts), "\n", " "), _WORD_END, r"\1 \2")
            texts = pc.if_else(pc.match_substring_regex(texts, _UNTOUCHED), texts, finer)
        split = pc.split_pattern(texts, " ")
        lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(lengths) - lengths
        coded = split.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        chunks = coded.dictionary
        whole = np.zeros(len(texts), bool)
        if self.spaced:
            # Runs of spaces belong together, so such texts are encoded whole.
            whole = pc.match_substring(texts, "  ").to_numpy(zero_copy_only=False)
        strange = pc.or_(pc.equal(chunks, ""), pc.match_substring(chunks, _MARK)).to_numpy(zero_copy_only=False)
        odd, at = np.flatnonzero(strange), np.flatnonzero(~strange)
        table, start, count = self._lookup(chunks.take(pa.array(at)))
        if len(odd):
            # Empty chunks: a trailing space where spaces count, else nothing.
            lists = self._plain([" " + x if self.spaced else x for x in chunks.take(pa.array(odd)).to_pylist()])
            starts, counts = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
            starts[at], counts[at] = start, count
            for i, ids in zip(odd, lists):
                starts[i], counts[i] = len(table), len(ids)
                table = np.append(table, np.array(ids, np.uint32))
            start, count = starts, counts
        start, count = start[which], count[which]
        if self.spaced:
            # The first chunk of a text has no space before it.
            heads = self._plain(chunks.take(pa.array(which[firsts])).to_pylist())
            sizes = np.fromiter(map(len, heads), np.int64, len(heads))
            start[firsts] = len(table) + np.cumsum(sizes) - sizes
            count[firsts] = sizes
            table = np.concatenate([table, np.fromiter((i for x in heads for i in x), np.uint32, int(sizes.sum()))])
        ends = np.cumsum(count)
        ids = table[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - count), count)]
        totals = np.add.reduceat(count, firsts) if len(firsts) else np.zeros(0, np.int64)
        if whole.any():
            pieces = np.split(ids, np.cumsum(totals)[:-1])
            odd_texts = np.flatnonzero(whole)
            for i, x in zip(odd_texts, self._plain([texts[int(i)].as_py() for i in odd_texts])):
                pieces[i] = np.array(x, np.uint32)
            ids, totals = np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        return ids, totals
