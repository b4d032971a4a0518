"""BPE encoding and decoding by dynamic programming over prefixes.

The tokenizer file (``tokenizers`` JSON with a BPE model, path given by the
caller) supplies vocabulary, merges, normalizer and pre-tokenizer; the library
only normalizes and splits into words.  The merging itself is done here:

* For a word, each prefix has exactly one last token in its BPE encoding.
  The tokens that end a prefix are found by the vocabulary's suffix-link
  automaton (Aho-Corasick), longest first.
* A token is the last one of a prefix just when it can stand after the last
  token of what is before it: the pair is *compatible* if merging their
  symbols by rank never joins across the border.  That is decided by undoing
  the latest merge on either side of the border, step by step, and looking for
  a border pair whose own merge would have come first.
* Back-pointers from the whole word give the exact ids.

Work is linear in the word times the number of tokens ending at a position, so
a word of 100,000 letters is no special case.  Word encodings and pair tests
are remembered per worker in tables of at most twice ``CACHE_WORDS`` and
``CACHE_PAIRS`` entries, some 100 MB (speed only).

Special tokens are cut out of the raw text first, as the library does with
``encode_special_tokens`` off.  Decoding joins the tokens' strings by a space,
which is what the library does for a file without a decoder; files with one
are refused.

Edge cases: null text counts as empty (no ids, empty string); repeated rows
give equal rows; an empty table gives an empty result; other columns are not
looked at.  The tokenizer is read by each task from its path, which must name
the same file on every machine; a word with a symbol that the vocabulary does
not hold raises, as there is no unknown token to fall back to.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from claimsdq.llm.common import map_batches

CACHE_WORDS = 100_000
CACHE_PAIRS = 200_000
#: Stands for the word-end suffix inside the automaton; no byte-level symbol.
_END = "￿"
_NEVER = float("inf")
#: A chunk of Latin letters and then marks, none of them an apostrophe (which
#: may open a word of its own): the commonest chunks, split without the library.
_PLAIN = re.compile(r"([a-z\xdf-\xf6\xf8-\xff]*)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)")
#: Beyond Latin-1 without the separators that blanks do not include: such text
#: needs the library's normalizer.
_BEYOND = re.compile(r"[^\x00-\x1b\x20-\xff]")


def _byte_symbols() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    follow from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + n for n, b in enumerate(rest)}


_BYTE_SYMBOLS = _byte_symbols()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PrefixBPE:
    """Encoder and decoder over one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or model.get("unk_token") or model.get("dropout") \
                or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError(f"{path}: only plain BPE files without decoder or fallback are supported")
        lib = Tokenizer.from_file(path)
        self._normalize = lib.normalizer.normalize_str if lib.normalizer else str
        self._split = lib.pre_tokenizer.pre_tokenize_str
        probe = "ab, c 1 d"
        whole, apart = self._split(probe), [p for chunk in probe.split(" ") for p in self._split(chunk)]
        # words that never hold a space can be found chunk by chunk
        self._by_chunk = [w for w, _ in whole] == [w for w, _ in apart]
        # Latin-1 text can be normalized here if the file asks for no more than
        # composition, blanks made single spaces and lower case
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        sample = "".join(c for c in map(chr, range(256)) if not 0x1C <= ord(c) < 0x20)
        self._plain_case = self._by_chunk and steps == ["NFC", "Replace", "Lowercase"] and \
            [c for c in self._normalize(sample).split(" ") if c] == sample.lower().split()
        self._suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError(f"{path}: added token {t['content']!r} has options that are not supported")
            self.tokens[t["id"]] = t["content"]
        longest = sorted(self._special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self._merge: dict[tuple[int, int], int] = {}    # pair -> rank
        self._made: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, ab = vocab[left], vocab[right], vocab[left + right]
            if (a, b) not in self._merge:
                self._merge[a, b] = rank
                self._made.setdefault(ab, (rank, a, b))
        self._automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if i in self._made or len(self._marked(token).rstrip(_END)) == 1:  # others are never produced
                word = self._marked(token)
                self._automaton.add_word(word, (i, len(word)))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._newer: dict[str, tuple[bytes, bytes]] = {}
        self._older: dict[str, tuple[bytes, bytes]] = {}

    def _marked(self, token: str) -> str:
        s = self._suffix
        return token[:-len(s)] + _END if s and token.endswith(s) and token != s else token

    def compatible(self, left: int, right: int) -> bool:
        """True if BPE over the two tokens' symbols gives exactly the two."""
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        merge, made = self._merge, self._made
        born_a, born_b = made.get(a, (-1,))[0], made.get(b, (-1,))[0]
        gone_a = gone_b = _NEVER      # rank of the merge that swallows a, b
        while True:
            rank = merge.get((a, b))
            if rank is not None:
                at = max(rank, born_a, born_b)
                # on a tie the leftmost merge goes first: inside the left
                # token before the border, the border before the right token
                if at < gone_a and at <= gone_b:
                    return False
            if born_a < 0 and born_b < 0:
                return True
            if born_a > born_b:
                gone_a, a = born_a, made[a][2]
                born_a = made.get(a, (-1,))[0]
            else:
                gone_b, b = born_b, made[b][1]
                born_b = made.get(b, (-1,))[0]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-tokenized word (byte-level symbols)."""
        n, pairs = len(word), self._pairs
        last, back = [-1] * (n + 1), [0] * (n + 1)
        plain = n - 1 if self._suffix else n      # ends before here are no word ends
        # matches come by end, longest first, so the first that fits is the one
        for at, (token, size) in self._automaton.iter(word + _END if self._suffix else word):
            if at < plain:
                end = at + 1
            elif at == n:
                end, size = n, size - 1
            else:
                continue
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = pairs.get(before << 32 | token)
                if fits is None:
                    fits = self.compatible(before, token)
                if not fits:
                    continue
            last[end], back[end] = token, start
        if last[n] < 0:
            raise ValueError(f"word has a symbol outside the vocabulary: {word[:40]!r}")
        ids, at = [], n
        while at:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def _known(self, key: str, ids) -> tuple[bytes, bytes]:
        """Remember (ids as little-endian 32-bit integers, decoded form)."""
        entry = (_packed(ids), " ".join([self.tokens[i] for i in ids]).encode("utf-8"))
        if ids and len(key) <= 64:
            if len(self._newer) >= CACHE_WORDS:
                self._older, self._newer = self._newer, {}
            self._newer[key] = entry
        return entry

    def _word(self, word: str) -> tuple[bytes, bytes]:
        """A word of letters, or of marks, as it stands in normalized text."""
        entry = self._newer.get(word)
        if entry is None:
            entry = self._older.get(word)
            if entry is None:
                entry = self._known(word, self.encode_word(
                    word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(_BYTE_SYMBOLS)))
            elif len(self._newer) < CACHE_WORDS:
                self._newer[word] = entry
        return entry

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """A piece of normalized text whose ends are ends of words."""
        plain = _PLAIN.fullmatch(chunk) if self._by_chunk else None
        if plain is None:
            entry = self._older.get(chunk)
            return entry or self._known(chunk, [i for word, _ in self._split(chunk) if word
                                                for i in self.encode_word(word)])
        letters, marks = plain.groups()      # two words at most
        if not marks:
            return self._word(letters)
        if not letters:
            return self._word(marks)
        a, b = self._word(letters), self._word(marks)
        return a[0] + b[0], a[1] + b" " + b[1]

    def _chunks(self, text: str) -> list[str] | tuple[str]:
        """The chunks of a text, normalized."""
        if self._plain_case and not _BEYOND.search(text):
            return text.lower().split()
        text = self._normalize(text)
        return text.split(" ") if self._by_chunk else (text,)

    def encode_with_text(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids (little-endian unsigned 32-bit) and their decoding (UTF-8)."""
        ids, decoded = [], []
        for piece in self._cut.split(text or "") if self._cut else [text or ""]:
            if piece in self._special:
                ids.append(_packed([self._special[piece]]))
                decoded.append(piece.encode("utf-8"))
                continue
            known = self._newer
            for chunk in self._chunks(piece):
                part = known.get(chunk)
                if part is None:
                    part = self._chunk(chunk) if chunk else None
                    known = self._newer
                    if not part or not part[0]:
                        continue
                ids.append(part[0])
                decoded.append(part[1])
        return b"".join(ids), b" ".join(decoded)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_with_text(text)[0], "<u4").tolist()

    def decode(self, ids) -> str:
        return " ".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=2)
def load(path: str) -> PrefixBPE:
    """One encoder per Python worker and file."""
    return PrefixBPE(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids (array<int>), decoded`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)      # bounds the ids held at once
                ids = [np.frombuffer(bpe.encode_with_text(t.as_py())[0], "<i4") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i.tolist()) for i in ids])],
                    names=["doc_id", "ids", "decoded"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, and the
    ids (array<int>) on request; decoded texts stay in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = load(path), hashlib.sha256
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                b = whole.slice(start, 512)
                rows = [bpe.encode_with_text(t.as_py()) for t in b.column(1)]
                cols = [b.column(0), pa.array([len(i) // 4 for i, _ in rows], pa.int64()),
                        pa.array([sha(i).hexdigest() for i, _ in rows]),
                        pa.array([sha(d).hexdigest() for _, d in rows])]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(i, "<i4") for i, _ in rows], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select("doc_id", "text"), run, schema + ", ids array<int>" * with_ids)
