"""Packing documents into training sequences: first-fit decreasing over a tournament tree.

A map over the documents: each task tokenizes its own rows, deals them at random into groups,
and packs each group by itself, so no row is shuffled and memory is bounded by ``BUFFER``
tokens and one document. A document is first cut into full sequences; its rest goes, longest
first, to the first open sequence with room, found in a tree that holds the largest free
space below each node. The emptiest sequences of a group then fill the gaps of the others,
cut where needed, and the last one is cut into sequences of power-of-two lengths, which take
no padding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from recordmill.llm import tokens as T

LENGTH = 1024
END = 0  # id after each document
GROUP = 1024  # documents packed together
BUFFER = 1 << 20  # tokens gathered before groups are dealt
CACHE = 1 << 20  # distinct words whose ids a worker remembers

RESULT = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3


class Tokenizer:
    """Byte-level BPE ids of whole batches, equal to those of ``tokenizers`` for the same file.

    Texts are cut into words by the file's fixed pattern with array operations; each distinct
    word is encoded once, and its ids are remembered. ``path`` names a byte-level BPE file with
    the pattern of the first such tokenizers (contractions, letters, digits, others, space).
    """

    def __init__(self, path: str):
        import regex
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        del spec["model"]["merges"]  # ids follow the order of merges
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        # Printable stand-ins for the 256 bytes, as in every byte-level vocabulary.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {
            bytes(byte_of[c] for c in word): i
            for word, i in spec["model"]["vocab"].items() if word not in self.added
        }
        self.words = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        points = np.arange(0x110000, dtype="<u4")
        every = points[(points < 0xD800) | (points > 0xDFFF)].tobytes().decode("utf-32-le")
        self.kind = np.full(0x110000, _OTHER, np.uint8)
        for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _DIGIT), (r"\p{White_Space}+", _SPACE)):
            for m in regex.finditer(pattern, every):
                self.kind[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def boundaries(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where words begin in the code points of some texts, which begin at ``first``."""
        n = len(points)
        kind = self.kind[points]
        begin = np.zeros(n + 4, bool)
        begin[1:n] = kind[1:] != kind[:-1]
        heads = np.zeros(n + 4, bool)
        heads[first[first < n]] = True
        begin |= heads
        # The last space before a word goes with it, and any other white space stands alone.
        after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~heads[1:n]) + 1 if n else np.zeros(0, int)
        begin[after - 1] = True
        begin[after] = points[after - 1] != 32
        quote = np.flatnonzero((points == 39) & begin[:n])
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        inside = ~heads[quote + 1]
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        long = inside & ~heads[quote + 2] & (
            (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        begin[quote[short | long] + 1] = False
        begin[quote[short] + 2] = True
        begin[quote[long] + 3] = True
        return np.flatnonzero(begin[:n])

    def _learn(self, hashes: np.ndarray, words: list[str]):
        if len(self.known) > CACHE:
            self._forget()
        found = [self.words.encode_ordinary(w) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(sizes) - sizes])[order]
        self.size = np.concatenate([self.size, sizes])[order]
        self.pool = np.concatenate([self.pool, np.fromiter((i for f in found for i in f), np.uint32, int(sizes.sum()))])
        self.known = known[order]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text with ``END`` after them; null is empty."""
        texts = [t or "" for t in texts]
        marked = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        plain = [("" if i in marked else t) for i, t in enumerate(texts)]
        text = "".join(plain)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum([len(t) for t in plain])])
        start = self.boundaries(points, first)
        end = np.append(start[1:], len(points)) if len(start) else start
        running = np.zeros(len(points) + 1, np.uint64)
        powers, inverses = T.power_tables(len(points) + 1)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[: len(points)], out=running[1:])
        h = T.mix((running[end] - running[start]) * inverses[start])
        words, at, back = np.unique(h, return_index=True, return_inverse=True)
        new = ~np.isin(words, self.known, assume_unique=True)
        if new.any() and len(self.known) > CACHE:
            self._forget()
            new[:] = True
        if new.any():
            self._learn(words[new], [text[a:b] for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist())])
        slot = np.searchsorted(self.known, words)[back]
        size, source = self.size[slot], self.at[slot]
        stop = np.cumsum(size)
        ids = self.pool[np.repeat(source - stop + size, size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        bounds = np.concatenate([[0], stop])[np.searchsorted(start, first)]
        tail = np.array([END], np.uint32)
        out = [np.concatenate([ids[a:b], tail]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for i in marked:  # texts that spell out an added token
            from tokenizers import Tokenizer as Whole

            whole = Whole.from_file(self.path).encode(texts[i], add_special_tokens=False).ids
            out[i] = np.concatenate([np.array(whole, np.uint32), tail])
        return out


def first_fit_decreasing(sizes: list[int], capacity: int = LENGTH) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, goes to the first bin with room."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [capacity] * (2 * leaves)  # the largest free space below each node
    bins: list[list[int]] = []
    for i in order:
        size, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(i)
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins


def pack_group(sizes: list[int], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)`` that hold every token once."""
    out = []
    rests = []
    for d, n in enumerate(sizes):
        for start in range(0, n - n % length, length):
            out.append([(d, start, length)])
        if n % length:
            rests.append((d, n - n % length, n % length))
    bins = [[rests[i] for i in b] for b in first_fit_decreasing([r[2] for r in rests], length)]
    loads = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -loads[b])
    low, high = 0, len(order) - 1
    while low < high:  # the emptiest sequence fills the fullest one's gap
        target, donor = bins[order[low]], bins[order[high]]
        gap = length - loads[order[low]]
        if not gap:
            low += 1
            continue
        if not donor:
            high -= 1
            continue
        d, start, n = donor.pop()
        moved = min(n, gap)
        if moved < n:
            donor.append((d, start, n - moved))
        target.append((d, start + n - moved, moved))
        loads[order[low]] += moved
        loads[order[high]] -= moved
    for b in order[:low] + order[low + 1 :]:
        if bins[b]:
            out.append(bins[b])
    last = list(bins[order[low]]) if order else []
    left = sum(n for _, _, n in last)
    for room in (1 << k for k in reversed(range(left.bit_length())) if left >> k & 1):
        held = []
        while room:
            d, start, n = last.pop(0)
            part = min(n, room)
            held.append((d, start, part))
            room -= part
            if part < n:
                last.insert(0, (d, start + part, n - part))
        out.append(held)
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of at most ``length`` ids.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers; ``start`` counts the
    document's ids before it, ``offset`` those before it in its sequence. ``tokenizer`` is the
    path of a byte-level BPE file that every worker has. A null or empty text is one ``END``.
    Repeated rows are packed each by itself, and a null ``doc_id`` stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Tokenizer(tokenizer)
        task = (TaskContext.get().partitionId() + 1) << 36
        count, held, size = 0, [], 0

        def flush():
            nonlocal count, held, size
            rng = np.random.default_rng([len(held), size])
            order = rng.permutation(len(held)).tolist()
            columns = [[] for _ in range(7)]
            for at in range(0, len(order), GROUP):
                group = [held[i] for i in order[at : at + GROUP]]
                for sequence in pack_group([len(ids) for _, ids in group], length):
                    offset = 0
                    for d, start, n in sequence:
                        doc_id, ids = group[d]
                        row = (doc_id, start, n, len(ids), task + count, offset, ids[start : start + n].astype("<u4").tobytes())
                        for c, v in zip(columns, row):
                            c.append(v)
                        offset += n
                    count += 1
            held, size = [], 0
            names = [f.split()[0] for f in RESULT.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.binary()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            for at in range(0, len(batch), 10_000):
                yield batch.slice(at, 10_000)

        for part in T.chunks(batches):
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                held.append((doc_id, ids))
                size += len(ids)
            if size >= BUFFER:
                yield from flush()
        if held:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
