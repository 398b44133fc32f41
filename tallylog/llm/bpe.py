"""BPE encoding and decoding with a prefix-sharing trie.

Encoding: a text is cut at white space and special tokens; each distinct piece is
normalised and pre-tokenised once, and its distinct words go into a trie of
symbols. A depth-first walk gives each trie node the last token of the encoding
of its prefix: the one vocabulary entry that ends there and whose pair with the
last token of the rest is one that merging leaves alone. The encoding of every
prefix is thus known from its ancestors and is computed once, whatever number of
words share it; a word's tokens are read by stepping back from its end.

Two neighbouring tokens are left alone if, undoing the merges that made them, the
later one first, no merge across their border would have come before the merge
that was undone.

All of it runs in map tasks: nothing is shuffled. A task keeps the encodings of
the pieces that it has seen, up to a fixed number.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import table

#: Pieces and pairs of tokens, and words, that a worker remembers; it forgets all at this number and goes on.
REMEMBERED = 1 << 18
REMEMBERED_WORDS = 1 << 19
#: Characters of texts, and of new pieces, that go into one trie.
TRIE_CHARS = 1 << 20
#: Rows that go out at once.
SLICE = 256
#: Cuts that are white space to every pre-tokeniser here.
_SPACE = re.compile(r"[ \t\n\r]+")
_PACK = {n: struct.Struct(f"<{n}I").pack for n in range(1, 33)}
#: The rule of the vocabularies that cut words into runs of letters, single digits and runs of other marks.
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A Latin-1 letter run with punctuation behind it, in its composed form.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)?")
#: Byte-level symbols: printable bytes stand for themselves, the others come from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}
#: All that may be white space besides.
_ODD_SPACE = re.compile(r"[\s\u180e\u200b\ufeff]")


class TrieEncoder:
    """A BPE vocabulary file of the tokenizers library, applied by prefix-sharing tries."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["pre_tokenizer"] is None or model["type"] != "BPE" or model.get("ignore_merges") or model.get("byte_fallback") or spec.get("decoder"):
            raise ValueError("only plain BPE with a pre-tokeniser and without a decoder is read here")
        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        # lower case, letters in one run, punctuation in another, byte-level symbols: what _PLAIN stands for
        split = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        self._plain = split == [_PLAIN_SPLIT] and self._split(self._normalizer.normalize_str("Üb.'s")) == ["Ã¼b", ".'", "s"]
        self._end = model.get("end_of_word_suffix") or ""
        self._ids: dict[str, int] = model["vocab"]
        self._specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self._specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.strings = {i: s for s, i in self._ids.items()} | {i: s for s, i in self._specials.items()}
        # merges: (left, right) -> (rank, merged); parts: merged -> (left, right, rank)
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b, c = self._ids[left], self._ids[right], self._ids[left + right]
            self._merges[a, b] = rank, c
            self._parts[c] = a, b, rank
        self._longest = max(len(s) - len(self._end) * s.endswith(self._end) for s in self._ids) if self._end else max(map(len, self._ids))
        self._left_alone: dict[int, bool] = {}
        self._made_whole: dict[int, bool] = {}
        self._learnt: dict[str, bytes] = {}  # words
        self._known: dict[str, bytes] = {}   # pieces

    def _stays(self, a: int, b: int) -> bool:
        """Does BPE leave the neighbours a, b as they are?"""
        if len(self._left_alone) >= REMEMBERED:
            self._left_alone.clear()
        got = self._left_alone[a << 32 | b] = self._compatible(a, b)
        return got

    def _compatible(self, a: int, b: int) -> bool:
        merges, parts = self._merges, self._parts
        # A merge across the border wins over the one undone last, if it ranks before it, or, when that was
        # on the right side, ranks the same: equal merges are made from left to right.
        limit, right_side = len(merges), False
        while True:
            across = merges.get((a, b))
            if across is not None and (across[0] < limit or right_side and across[0] == limit):
                return False
            left, right = parts.get(a), parts.get(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and left[2] > right[2]:
                a, limit, right_side = left[1], left[2], False
            else:
                b, limit, right_side = right[0], right[2], True

    def _encode_words(self, words: list[str]) -> None:
        """Learn the tokens of distinct words in sorted order.

        Inserted in this order, the words visit the nodes of their trie depth first: a
        branch is done once a word leaves it, so only the path to the last word is held.
        """
        ids, left_alone, whole, stays, longest, end = self._ids.get, self._left_alone, self._whole, self._stays, self._longest, self._end
        last: list[int] = [-1]            # last token of each prefix of the path
        size: list[int] = [0]             # symbols in that token
        path, learnt, packs = "", self._learnt, _PACK
        for word in words:
            n = len(word) - 1             # the last symbol carries the end mark: no node is shared there
            shared, most = 0, min(len(path), n)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            for depth in range(shared, n + 1):
                path = word[:depth + 1] if depth < n else word + end
                for at in range(depth + 1 - longest if depth >= longest else 0, depth + 1):
                    token = ids(path[at:])
                    if token is not None:
                        if at:
                            stay = left_alone.get(last[at] << 32 | token)
                            if stay is None:
                                stay = stays(last[at], token)
                        else:
                            stay = whole(token)
                        if stay:
                            break
                else:
                    raise ValueError(f"no encoding for {path!r}")
                last.append(token)
                size.append(depth + 1 - at)
            tokens, at = [], n + 1
            while at:
                tokens.append(last[at])
                at -= size[at]
            tokens.reverse()
            learnt[word] = pack(*tokens) if (pack := packs.get(len(tokens))) else np.array(tokens, "<u4").tobytes()
            last.pop()
            size.pop()
            path = word[:n]

    def _whole(self, token: int) -> bool:
        """Is the token what BPE makes of its own symbols?"""
        got = self._made_whole.get(token)
        if got is None:
            parts = self._parts.get(token)
            got = parts is None or self._whole(parts[0]) and self._whole(parts[1]) and self._until(*parts)
            self._made_whole[token] = got
        return got

    def _until(self, a: int, b: int, rank: int) -> bool:
        """Are the halves of a merge left alone until that merge?"""
        held = self._merges.pop((a, b))
        try:
            return self._compatible(a, b)
        finally:
            self._merges[a, b] = held

    def _words(self, pieces: list[str]) -> list[list[str]]:
        """The pre-tokenised words of each piece: plain ones here, the others by the library."""
        if not self._plain:
            return self._asked(pieces)
        out: list[list[str]] = []
        ask: list[int] = []
        for i, piece in enumerate(pieces):
            m = _PLAIN.fullmatch(piece)
            if m is None:
                ask.append(i)
                out.append([])
                continue
            run, marks = m.groups()
            run = run.lower()
            if not run.isascii():
                run = run.encode().decode("latin-1").translate(_SYMBOLS)
            out.append([run, marks] if marks else [run])
        for i, words in zip(ask, self._asked([pieces[i] for i in ask])):
            out[i] = words
        return out

    def _asked(self, pieces: list[str]) -> list[list[str]]:
        """The pre-tokenised words of each piece: many pieces in one call, set apart by white space."""
        if odd := [i for i, p in enumerate(pieces) if _ODD_SPACE.search(p)]:
            plain = iter(self._asked([p for p in pieces if not _ODD_SPACE.search(p)]))
            alone = {i: self._split(self._normalizer.normalize_str(pieces[i]) if self._normalizer else pieces[i]) for i in odd}
            return [alone[i] if i in alone else next(plain) for i in range(len(pieces))]
        if not pieces:
            return []
        text = "\n".join(pieces)
        text = self._normalizer.normalize_str(text) if self._normalizer else text
        lengths = [len(p) for p in _SPACE.split(text)]
        if len(lengths) != len(pieces):
            return [self._split(self._normalizer.normalize_str(p) if self._normalizer else p) for p in pieces]
        out: list[list[str]] = [[] for _ in pieces]
        i, end = 0, lengths[0]
        for word, (start, _) in self._splitter.pre_tokenize_str(text):
            while start >= end:
                i += 1
                end += 1 + lengths[i]
            out[i].append(word)
        return out

    def _split(self, text: str) -> list[str]:
        return [w for w, _ in self._splitter.pre_tokenize_str(text) if w]

    def learn(self, pieces: set[str]) -> None:
        """Encode new pieces, over a trie for each TRIE_CHARS characters."""
        todo = sorted(pieces)
        while todo:
            part, chars = [], 0
            while todo and chars < TRIE_CHARS:
                part.append(todo.pop())
                chars += len(part[-1])
            words = self._words(part)
            if len(self._learnt) > REMEMBERED_WORDS:
                self._learnt.clear()
            self._encode_words(sorted({w for own in words for w in own if w not in self._learnt}))
            learnt, known = self._learnt, self._known
            for piece, own in zip(part, words):
                known[piece] = learnt[own[0]] if len(own) == 1 else b"".join([learnt[w] for w in own])

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The token ids of whole texts, one after the other, as little-endian unsigned 32-bit integers."""
        split = self._special.split if self._special else lambda t: [t]
        at = 0
        while at < len(texts):
            runs, pieces, chars = [], set(), 0
            while at < len(texts) and chars < TRIE_CHARS:
                # odd runs are special tokens
                runs.append([run if i % 2 else [p for p in _SPACE.split(run) if p] for i, run in enumerate(split(texts[at]))])
                pieces.update(*runs[-1][::2])
                chars += len(texts[at])
                at += 1
            if len(self._known) > REMEMBERED:
                self._known.clear()
            self.learn({p for p in pieces if p not in self._known})
            known = self._known.__getitem__
            for text in runs:
                yield b"".join([b"".join(map(known, run)) if i % 2 == 0 else _PACK[1](self._specials[run])
                                for i, run in enumerate(text)])

    def encode(self, text: str) -> np.ndarray:
        """The token ids of a whole text."""
        return np.frombuffer(next(self.encode_all([text])), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids, special tokens included: their strings, one space between."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """The encoder of a vocabulary file; one in each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def _mapped(df: DataFrame, column: str, keep: list[str], made: pa.Schema, make: Callable) -> DataFrame:
    """``keep`` of ``df`` and the columns ``made`` from ``column``, SLICE rows at a time."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep if c not in made.names], F.col(column).alias("__given"))
    names = rows.columns[:-1]
    schema = rows.drop("__given").schema
    for f in made:
        schema = schema.add(f.name, {"int64": "long", "binary": "binary", "string": "string"}[str(f.type)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = make(part.column(len(names)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(len(names))], *[pa.array(c, f.type) for c, f in zip(columns, made)]],
                    names=[*names, *made.names])

    return rows.mapInArrow(apply, schema)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) of ``docs`` with ``n_tokens`` (long) and ``token_ids``
    (binary: little-endian unsigned 32-bit ids).

    A null text counts as empty: no tokens. Columns of these names are replaced; __given
    is not allowed. Whole texts are encoded, however long (a task holds a text and its
    ids). Rows are neither moved nor dropped; repeated ones are encoded alike, and an empty
    table gives no rows. ``vocabulary`` is the path of the file, the same on each executor.
    """
    def make(texts: list[str | None]) -> tuple[list[int], list[bytes]]:
        ids = list(encoder(vocabulary).encode_all([t or "" for t in texts]))
        return [len(x) // 4 for x in ids], ids

    made = pa.schema([("n_tokens", pa.int64()), ("token_ids", pa.binary())])
    return _mapped(docs, text, docs.columns if keep is None else keep, made, make)


def decode(tokens: DataFrame, vocabulary: str, token_ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) of ``tokens`` with ``decoded`` (string); null ids give an empty text.
    Other columns, repeated rows, long rows and empty tables are as in ``encode``."""
    def make(packed: list[bytes | None]) -> tuple[list[str]]:
        bpe = encoder(vocabulary)
        return ([bpe.decode(np.frombuffer(b or b"", "<u4")) for b in packed],)

    return _mapped(tokens, token_ids, tokens.columns if keep is None else keep, pa.schema([("decoded", pa.string())]), make)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The path of an installed public vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the decoded text of each row of ``docs`` (doc_id, text)."""
    tokens = encode(docs, vocabulary, keep=["doc_id"]).withColumn("ids_sha256", F.sha2("token_ids", 256))
    out = decode(tokens, vocabulary, keep=["doc_id", "n_tokens", "ids_sha256"])
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents`` with the word BPE vocabulary."""
    return token_digests(table(spark, sf_dir, "documents"), vocabulary_path())
