"""Token ids of whole texts by a public tokenizer, with a bounded cache of words.

The word tokenizer drops white space before it merges, so a text's ids are the ids of its
words one after another. Each distinct word is encoded once and its ids are then gathered
by numpy; a full cache keeps the words that came again since it was last full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from mixlab.llm.text import Words, chunks, give_back, keep, trim

TOKENIZER = "word_bpe_49k.json"
# Flat arrays of some 33 bytes a word, so about one million words.
CACHE_BYTES = 32 << 20
_LOT = 10_000

# A digit is always a token of its own here, so it can part words in one call.
_MARK = "7"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of words, found by the word's 64-bit hash in sorted flat arrays."""

    def __init__(self, path: str, capacity: int = CACHE_BYTES) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.capacity = capacity
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        probe = self.tokenizer.encode(f"a {_MARK} b", add_special_tokens=False).ids
        if len(self.mark) != 1 or probe.count(self.mark[0]) != 1:
            raise ValueError("this tokenizer does not drop white space between words")
        self.keep(np.zeros(0, np.int64))

    keys = np.zeros(0, np.uint64)
    ids = np.zeros(0, np.uint32)
    start = np.zeros(0, np.int64)
    length = np.zeros(0, np.int32)

    def size(self) -> int:
        """Bytes of the cached words."""
        return 21 * len(self.keys) + 4 * len(self.ids)

    def keep(self, places: np.ndarray) -> None:
        """Only the words at ``places`` (ascending) stay; none of them counts as met again any more."""
        sizes, starts = self.length[places], self.start[places]
        ends = np.cumsum(sizes, dtype=np.int64)
        self.ids = self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        self.keys, self.length, self.start = self.keys[places], sizes, ends - sizes
        self.met = np.zeros(len(places), bool)

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word: long joined runs for ordinary words, singly those that hold the mark."""
        out: list[np.ndarray | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if _MARK not in w]
        runs = [plain[i : i + 200] for i in range(0, len(plain), 200)]
        joined = [f" {_MARK} ".join(words[i] for i in run) for run in runs]
        mark = self.mark[0]
        for run, got in zip(runs, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(got.ids, np.uint32)
            cuts = np.flatnonzero(ids == mark)
            if len(cuts) != len(run) - 1:  # another way to spell the mark
                continue
            for i, part in zip(run, np.split(ids, cuts)):
                out[i] = part
            for i in run[1:]:
                out[i] = out[i][1:]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, got in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(got.ids, np.uint32)
        return out

    def _add(self, hashes: np.ndarray, words: Words, places: np.ndarray) -> None:
        """The words at ``places`` of ``words``, with their hashes."""
        # In lots, of which only flat arrays stay: strings, encodings and arrays of one word take many times the size of the ids.
        flat, lengths = [self.ids], [np.zeros(0, np.int32)]
        for low in range(0, len(places), _LOT):
            own = places[low : low + _LOT]
            parts = self._encode([words.data[a:b].tobytes().decode() for a, b in zip(words.starts[own].tolist(), words.ends[own].tolist())])
            lengths.append(np.fromiter(map(len, parts), np.int32, len(parts)))
            flat.append(np.concatenate(parts))
            del parts
        sizes = np.concatenate(lengths)
        starts = len(self.ids) + np.cumsum(sizes, dtype=np.int64) - sizes
        self.ids = np.concatenate(flat)
        del flat, lengths
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        del keys
        self.start = np.concatenate([self.start, starts])[order]
        self.length = np.concatenate([self.length, sizes])[order]
        self.met = np.concatenate([self.met, np.zeros(len(hashes), bool)])[order]

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key, and whether it is there."""
        at = np.searchsorted(self.keys, keys)
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == keys[there]
        return at, there

    def spans(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids start in ``ids``, and how many there are."""
        codes, distinct = pd.factorize(words.hashes())
        if self.size() > self.capacity:
            # Words met again since the last turn stay, unless they are too many themselves.
            kept = np.flatnonzero(self.met)
            self.keep(kept if 2 * (21 * len(kept) + 4 * int(self.length[kept].sum())) <= self.capacity else kept[:0])
        at, there = self._places(distinct)
        # A word that was new in an earlier chunk and comes again; most words never do.
        self.met[at[there]] = True
        if not there.all():
            new = np.flatnonzero(~there)
            first = np.zeros(len(distinct), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            self._add(distinct[new], words, first[new])
            at, _ = self._places(distinct)
        return self.start[at][codes], self.length[at][codes]

    def counts(self, words: Words) -> np.ndarray:
        """Number of ids of each document."""
        _, sizes = self.spans(words)
        sums = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=sums[1:])
        return np.diff(sums[words.first])

    def documents(self, words: Words) -> Iterator[np.ndarray]:
        """The ids of each document."""
        starts, sizes = self.spans(words)
        sums = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=sums[1:])
        flat = self.ids[np.repeat(starts - sums[:-1], sizes) + np.arange(sums[-1])]
        for low, high in zip(sums[words.first[:-1]], sums[words.first[1:]]):
            yield flat[low:high]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder; kept between tasks of the same Python worker."""
    return keep(f"tokens {path}", lambda: WordEncoder(path))


def encoded(batches: Iterator[pa.RecordBatch], text: str, path: str) -> Iterator[tuple[pa.RecordBatch, WordEncoder, Words]]:
    # What other operators left in this worker goes first; what these batches leave free goes at the end.
    name = f"tokens {path}"
    give_back(name)
    coder = encoder(path)
    for batch in batches:
        for part, data, offsets in chunks(batch, text):
            yield part, coder, Words(data, offsets)
            # Arrays of a chunk are of all sizes and leave holes, which would add up to a multiple of the cache.
            trim()
    give_back(name)
