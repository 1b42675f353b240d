"""Token ids of whole texts for byte-pair tokenizers with word ends, a batch of texts at a time.

Each distinct word of a batch is encoded once. Words of plain letters, digits and marks are merged
together as arrays: all start as bytes, and each round joins, in every word, the pair of the lowest
rank. All other words go to the tokenizers library one by one. The same holds for a tokenizer file
with another normaliser or pre-tokenizer than the one this module knows: then every word does.
Nothing is kept from batch to batch.

Defined cases. A null text is an empty one. Every text ends with the end token. White space
separates words and is not encoded, so a tokenizer that encodes it must not be used.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from atlasmith.llm import _shared as S

END = 2
_NONE = np.int32(2**31 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18
#: The pre-tokenizer whose pre-tokens of plain words are runs of letters, single digits and runs of marks.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _classes() -> np.ndarray:
    """0: other, 1: letter, 2: digit, 3: mark, for each byte; the bytes of U+00DF to U+00FF are checked in pairs."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = 3
    kind[ord("a") : ord("z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    # Capitals of texts with special tokens, contractions, and what may be a special token.
    kind[[*range(ord("A"), ord("Z") + 1), ord("'"), ord("<")]] = 0
    return kind


def byte_letters() -> list[str]:
    """The printable letter that byte-level tokenizers have for each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(own)]
    place = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [place[b] for b in range(256)]


def gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces values[begin : begin + size] in the order of index, and where each of them ends."""
    lengths = size[index]
    stops = np.cumsum(lengths)
    source = np.repeat(begin[index] - stops + lengths, lengths) + np.arange(stops[-1] if len(stops) else 0)
    return values[source], stops


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], spec["model"]["vocab"]
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        split = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.merges = model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("ignore_merges") and _SPLIT in split
        if self.merges:
            pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
            self.size = len(vocabulary)
            first, second = (np.array([vocabulary[p[i]] for p in pairs], np.uint64) for i in (0, 1))
            self._fill(first * np.uint64(self.size) + second)
            self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
            self.inner, self.last = (np.array([vocabulary.get(x + end, -1) for x in byte_letters()], np.int32) for end in ("", "</w>"))
            self.merges = bool((self.inner >= 0).all() and (self.last >= 0).all())

    def _fill(self, keys: np.ndarray) -> None:
        """An open hash table of pairs; self.deep is how far an entry may lie from its place."""
        self.keys, self.rank = np.full(1 << _BITS, 2**64 - 1, np.uint64), np.full(1 << _BITS, _NONE)
        self.deep = 0
        places = ((keys * _ODD) >> np.uint64(64 - _BITS)).astype(np.int64).tolist()
        for rank, (place, key) in enumerate(zip(places, keys, strict=True)):
            deep = 0
            while self.rank[(place + deep) % (1 << _BITS)] != _NONE and self.keys[(place + deep) % (1 << _BITS)] != key:
                deep += 1
            at = (place + deep) % (1 << _BITS)
            if self.rank[at] == _NONE:
                self.keys[at], self.rank[at] = key, rank
                self.deep = max(self.deep, deep)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, _NONE if it is never joined."""
        key = a.astype(np.uint64) * np.uint64(self.size) + b.astype(np.uint64)
        at = ((key * _ODD) >> np.uint64(64 - _BITS)).astype(np.int64)
        other = self.keys[at] != key
        found = self.rank[at]
        open_ = np.flatnonzero(other & (found != _NONE))
        found[other] = _NONE
        for deep in range(1, self.deep + 1):
            if not len(open_):
                break
            place = (at[open_] + deep) % (1 << _BITS)
            other, rank = self.keys[place] != key[open_], self.rank[place]
            found[open_] = np.where(other, _NONE, rank)
            open_ = open_[other & (rank != _NONE)]
        return found

    def _merge(self, sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of pre-tokens, given their bytes as tokens, and where they start."""
        n = len(starts)
        word = np.repeat(np.arange(n, dtype=np.int32), np.diff(np.append(starts, len(sym))))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(sym), _NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self._ranks(sym[inside], sym[inside + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(first, len(sym)))
            best = np.minimum.reduceat(rank, first)
            over = best == _NONE
            if over.any():
                gone = np.repeat(over, size)
                done.append((sym[gone], word[gone]))
                stay = ~gone
                sym, word, rank, best, size = sym[stay], word[stay], rank[stay], best[~over], size[~over]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            # Of touching equal pairs, every second one of a chain goes, from the left.
            close = np.diff(hit) == 1
            if close.any():
                begin = np.maximum.accumulate(np.where(np.concatenate(([True], ~close)), np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            sym[hit] = self.merged[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))
            sym, word, rank = sym[keep], word[keep], rank[keep]
            rank[now] = _NONE
            for left in (now[now + 1 < len(sym)], now[now > 0] - 1):
                left = left[word[left] == word[left + 1]]
                rank[left] = self._ranks(sym[left], sym[left + 1])
        sym, word = (np.concatenate([x[i] for x in done]) if done else np.empty(0, np.int32) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        return sym[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=n))))

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, done) of the words that arrays can encode."""
        n = len(words)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        size = np.diff(offsets)
        kind = _classes()[data]
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x9F) & (data[1:] != 0xB7) & (data[1:] <= 0xBF)) if len(data) > 1 else np.empty(0, np.int64)
        kind[lead] = kind[lead + 1] = 1
        word = np.repeat(np.arange(n, dtype=np.int32), size)
        done = (np.bincount(word[kind == 0], minlength=n) == 0) & (size > 0)
        use = done[word]
        data, kind, word = np.ascontiguousarray(data[use]), kind[use], word[use]
        if not len(data):
            return np.empty(0, np.int32), np.zeros(n + 1, np.int64), done
        starts = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 2) | (word[1:] != word[:-1]))))
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        distinct, index = parts.dictionary, np.asarray(parts.indices)
        edges = np.frombuffer(distinct.buffers()[1], np.int32)[: len(distinct) + 1].astype(np.int64)
        letters = np.frombuffer(distinct.buffers()[2], np.uint8)[: edges[-1]]
        sym = self.inner[letters]
        sym[edges[1:] - 1] = self.last[letters[edges[1:] - 1]]
        ids, begin = self._merge(sym, edges[:-1])
        ids, stops = gathered(ids, begin[:-1], np.diff(begin), index)
        ends = np.concatenate(([0], stops))
        per_word = np.concatenate(([0], np.cumsum(np.bincount(word[starts], minlength=n))))
        return ids, ends[per_word], done

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): the ids of all texts one after another, and where each text's begin, with the end of the last."""
        texts = texts.cast(pa.string()).fill_null("")
        special = pc.match_substring(texts, "<|")
        # The tokenizer lower-cases too; only its special tokens are told from capitals.
        lower = pc.if_else(special, texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(lower)
        edges = np.asarray(lists.offsets).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        distinct, index = words.dictionary, np.asarray(words.indices)
        n = len(distinct)
        if self.merges:
            ids, starts, done = self._plain(distinct)
        else:
            ids, starts, done = np.empty(0, np.int32), np.zeros(n + 1, np.int64), np.zeros(n, bool)
        others = np.flatnonzero(~done & (np.asarray(pc.binary_length(distinct)) > 0)) if n else np.empty(0, np.int64)
        encoded = self.tokenizer.encode_batch_fast(distinct.take(pa.array(others)).to_pylist(), add_special_tokens=False) if len(others) else []
        extra = [np.array(x.ids, np.int32) for x in encoded]
        size = np.append(np.diff(starts), 1)
        begin = np.append(starts[:-1], len(ids))
        size[others] = [len(x) for x in extra]
        begin[others] = len(ids) + 1 + np.concatenate(([0], np.cumsum([len(x) for x in extra])))[:-1] if len(others) else []
        every = np.concatenate([ids, np.array([END], np.int32), *extra]).astype(self.kind)
        # The end token is one more word, number n, after the last word of each text.
        index = np.insert(index.astype(np.int64), edges[1:] - edges[0], n)
        found, stops = gathered(every, begin, size, index)
        text_ends = stops[edges[1:] - edges[0] + np.arange(len(texts))] if len(texts) else np.empty(0, np.int64)
        return found, np.concatenate(([0], text_ends))


S.by_value(__name__)
