"""BPE encoding and decoding by a prefix-sharing traversal of a trie.

The distinct words of a batch go into a trie of symbols. In a depth-first walk each node gets one state, the last token
of the encoding of the prefix that it stands for: the only token that ends there and may follow the state at the
prefix before it. Two tokens may stand side by side when BPE leaves their joined symbols as these two tokens; a
sequence is BPE's own encoding when all its neighbours may. So a prefix that many words share is encoded once, and a
word's ids follow from the states along its path. Workers remember words they have met, up to a bound.

Defined results: null text is the empty text, which has no ids and decodes to the empty text; repeated rows and repeated
or null ids give a row each; an empty table gives none; the strings of special tokens in a text become those tokens, as
in the library; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, worker_memory
from .wordclass import LETTERS, NUMBERS, SPACE, UNUSUAL, byte_symbols

#: Bytes of words and of token pairs that a worker remembers at most. A full memory of words is kept while it serves most words, else begun anew.
WORD_BYTES, PAIR_BYTES, STALE = 40_000_000, 40_000_000, 0.5
#: What a remembered word and a remembered pair take beside their own bytes, about.
PER_WORD, PER_PAIR = 190, 130
#: Symbols from which on a word has no nodes in the trie; it would hardly share them.
LONG = 256
#: Words that a trie holds at most.
TOGETHER = 4_000
#: Characters of texts that are encoded together.
RUN = 2_000_000

# The vocabulary's own word pattern, with its classes written out for the code points below U+0250.
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACE}{LETTERS}{NUMBERS}]+")


class TrieBpe:
    """Encoder and decoder for a BPE vocabulary file with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.tails = {t[i:] for t in self.vocab for i in range(len(t))}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added_re = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.text_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self.symbols = [self._symbols(self.text_of[i]) if i in self.text_of else [] for i in range(max(self.text_of) + 1)]
        self.path = path
        self.byte = byte_symbols()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.ids: dict[str, bytes] = {}
        self.held = 0  # bytes of ids and their keys
        self.new: list[str] = []  # the keys that the present call has added
        self.spelled = [self.text_of.get(i, "").encode() for i in range(len(self.symbols))]

    @cached_property
    def library(self):
        """The library's normaliser and pre-tokenizer, for texts with unusual characters; the words go through the trie all the same."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _symbols(self, token: str) -> list[str]:
        """The symbols that BPE starts from for this token."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            token = token[: -len(self.end)]
            return [*token[:-1], sys.intern(token[-1] + self.end)]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE: the pair of the lowest rank first, from the left."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _stands(self, token: int) -> bool:
        """Whether BPE makes this very token out of its own symbols."""
        if (known := self.alone.get(token)) is None:
            known = self.alone[token] = self.merged(self.symbols[token]) == [self.text_of[token]]
        return known

    def _follows(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side."""
        key = left << 32 | right
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) * PER_PAIR >= PAIR_BYTES:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.symbols[left] + self.symbols[right]) == [self.text_of[left], self.text_of[right]]
        return known

    def _state(self, path: str, n: int, last: list[int], end: str) -> int:
        """The last token of the encoding of path[:n], whose end is marked with end; last has the states of shorter prefixes."""
        vocab, tails = self.vocab, self.tails
        for size in range(1, n + 1):
            tail = path[n - size : n] + end
            if tail not in tails:
                break
            token = vocab.get(tail)
            if token is not None and self._stands(token) and (size == n or self._follows(last[n - size], token)):
                return token
        raise ValueError(f"no token ends {path[:n]!r}")

    def _traced(self, word: str, last: list[int]) -> list[int]:
        """The ids of a word from the states of its prefixes."""
        token = self._state(word, len(word), last, self.end)
        ids, at = [token], len(word) - len(self.symbols[token])
        while at:
            ids.append(last[at])
            at -= len(self.symbols[last[at]])
        return ids[::-1]

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of each word, given in the vocabulary's byte symbols."""
        root: dict = {}
        done: dict[str, list[int]] = {}
        for w in words:
            if len(w) > LONG:  # a branch of its own, walked without nodes
                last = [0]
                for n in range(1, len(w)):
                    last.append(self._state(w, n, last, ""))
                done[w] = self._traced(w, last)
                continue
            node = root
            for c in w[:-1]:
                node = node.setdefault(c, {})
            node.setdefault(None, []).append(w[-1])  # how words end here
        # last[n] is the state at depth n of the present path.
        last, stack, path = [0], [(0, "", root)], ""
        while stack:
            depth, symbol, node = stack.pop()
            if depth:
                path = path[: depth - 1] + symbol
                del last[depth:]
                last.append(self._state(path, depth, last, ""))
            for final in node.get(None, ()):
                word = path[:depth] + final
                done[word] = self._traced(word, last)
            stack.extend((depth + 1, c, child) for c, child in node.items() if c is not None)
        return done

    def _learn(self, words: set[str], raw: bool) -> None:
        byte = self.byte
        spelled = {w: "".join([byte[b] for b in w.encode()]) for w in words} if raw else {w: w for w in words}
        order = sorted(spelled, key=spelled.__getitem__)
        for at in range(0, len(order), TOGETHER):  # neighbours in the order share their prefixes
            part = order[at : at + TOGETHER]
            encoded = self.encode_words([spelled[w] for w in part])
            for w in part:
                self._keep(w if raw else f"\0{w}", encoded[spelled[w]])

    def _keep(self, key: str, ids: list[int]) -> None:
        self.ids[key] = np.array(ids, "<u4").tobytes()
        self.held += PER_WORD + len(key) + 4 * len(ids)
        self.new.append(key)

    def _unusual(self, text: str) -> list[str]:
        """Keys of the words of a text with special tokens or unusual characters."""
        keys = []
        for piece in self.added_re.split(text) if self.added_re else [text]:
            if piece in self.added:
                if f"\1{piece}" not in self.ids:
                    self._keep(f"\1{piece}", [self.added[piece]])
                keys.append(f"\1{piece}")
            elif piece:
                words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))]
                self._learn({w for w in words if f"\0{w}" not in self.ids}, raw=False)
                keys += [f"\0{w}" for w in words]
        return keys

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(packed 32-bit ids, decoded text in UTF-8) of each text."""
        return list(self.encoded(texts))

    def encoded(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Like encode(), one text after the other, so that only their distinct words are held together."""
        usual = [not UNUSUAL.search(t) and not (self.added_re and self.added_re.search(t)) for t in texts]
        words: set[str] = set()
        for t, u in zip(texts, usual, strict=True):
            if u:
                words.update(_WORDS.findall(t.lower()))
        fresh = words - self.ids.keys()
        full = self.held >= WORD_BYTES
        if full and len(fresh) > STALE * len(words):
            self.ids.clear()
            self.held = 0
            fresh, full = words, False
        self.new = []
        self._learn(fresh, raw=True)
        del words, fresh
        ids, spelled = self.ids, self.spelled
        for t, u in zip(texts, usual, strict=True):
            packed = b"".join(map(ids.__getitem__, _WORDS.findall(t.lower()) if u else self._unusual(t)))
            yield packed, b" ".join(map(spelled.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        if full:
            for k in self.new:
                self.held -= PER_WORD + len(k) + len(self.ids.pop(k))
        self.new = []


def encoder_of(path: str) -> TrieBpe:
    """This process's encoder."""
    return worker_memory(("trie", path), lambda: TrieBpe(path))


def trie_bpe(docs: DataFrame, vocabulary_path: str, with_text: bool = False) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded."""
    ship(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * with_text

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder_of(vocabulary_path)
        for f in frames:
            texts, start = f["text"].tolist(), 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) <= RUN):
                    size += len(texts[stop])
                    stop += 1
                # Texts and ids are held only as far as they are asked for.
                done = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest(), *((np.frombuffer(i, "<u4").astype("int64"), d.decode()) if with_text else ())) for i, d in coder.encoded(texts[start:stop])]
                out = pd.DataFrame(done, columns=["n_tokens", "ids_sha256", "decoded_sha256", *(("ids", "decoded") if with_text else ())])
                out.insert(0, "doc_id", f["doc_id"].iloc[start:stop].astype("Int64").to_numpy(dtype=object, na_value=None))
                yield out
                start = stop

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, schema)
