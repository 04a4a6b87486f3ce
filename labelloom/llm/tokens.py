"""Token ids and token bytes by public tokenizer files.

A byte-level BPE file whose merges are numbered in their order is read into ranks, which one
library encodes faster; the ids are the file's own, as the tests check for every code point. Any other
file of that library is used as it is.

Many texts are encoded together: they are cut, as bytes, where the file's word rule always cuts, equal
units are found by a rolling hash (and compared), and a different unit is encoded once. A memo of units is bounded by
its bytes.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np

# Fixed value: the word rule of byte-level files ("ByteLevel", use_regex).
BYTE_LEVEL_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The byte of each sign of the byte-level alphabet: visible Latin-1 signs are themselves, the rest follow from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids of a byte-level file by token bytes; None unless ids alone decide the merges."""
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = not any(spec[k] for k in ("normalizer", "post_processor", "truncation", "padding"))
    usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if not plain or not usual or model["type"] != "BPE" or any(model.get(k) for k in odd):
        return None
    vocab = model["vocab"]
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in made or any(a >= b for a, b in zip(made, made[1:])):
        return None
    byte, added = byte_alphabet(), {t["content"] for t in spec["added_tokens"]}
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in added}


MEMO_BYTES = 24 * 1024 * 1024
# About what an entry of the memo takes besides its bytes.
ENTRY_BYTES = 170
# Longer texts are encoded by themselves, without tables of their bytes.
LONG_BYTES = 4_000_000
ODD = 0x9E3779B97F4A7C15

# White space of the word rule.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
INNER = re.compile(f"[{WHITE}]")

SPACE, BLANK, PERHAPS, WORD, STOP = 1, 2, 4, 8, 16


def _byte_classes() -> np.ndarray:
    """What a byte can be to the word rule; `PERHAPS` begins signs some of which are white space."""
    out = np.zeros(256, np.uint8)
    out[[*range(9, 14), 32]] = BLANK
    out[32] |= SPACE
    out[[0xC2, 0xE1, 0xE2, 0xE3]] = PERHAPS
    out[[b for b in range(128) if chr(b).isalnum()]] = WORD
    out[[ord("."), ord(",")]] = STOP
    return out


CLASSES = _byte_classes()


def unit_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where units of joined texts start: places at which the word rule cuts whatever stands around.

    White space before anything else is cut off what precedes it, and, unless it is a space, from what follows. A stop
    or comma is cut off a letter or digit.
    """
    if not len(data):
        return np.array([], np.int64)
    kind = CLASSES[data]
    after, before = np.r_[kind[1:], BLANK].astype(np.uint8), np.r_[np.uint8(0), kind[:-1]]
    inner = text_starts[(text_starts > 0) & (text_starts < len(data))]
    after[inner - 1], before[inner] = BLANK, 0
    last = ((kind & BLANK) != 0) & ((after & (BLANK | PERHAPS)) == 0)
    cut = last | (((kind & STOP) != 0) & ((before & WORD) != 0))
    cut[1:] |= (last & ((kind & SPACE) == 0))[:-1]
    cut[0] = True
    cut[inner] = True
    return np.flatnonzero(cut)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    both = [np.full(size, x, np.uint64) for x in (ODD, pow(ODD, -1, 2**64))]
    for x in both:
        x[0] = 1
        np.cumprod(x, out=x)
    return both[0], both[1]


def equal_units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each different unit its first place among `starts`, and which of these each unit is."""
    size = len(data)
    ends = np.r_[starts[1:], size]
    up, down = _powers(1 << max(size, 1 << 18).bit_length())
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:size])]
    _, first, which = np.unique((sums[ends] - sums[starts]) * down[starts], return_index=True, return_inverse=True)
    # Units of one hash are compared with its first one; should any differ, each unit stands for itself.
    lengths, model = ends - starts, first[which]
    same = (lengths == lengths[model]).all() and (data[np.arange(size) + np.repeat(starts[model] - starts, lengths)] == data).all()
    return (first, which) if same else (np.arange(len(starts)), np.arange(len(starts)))


class ByteTokenizer:
    """Ids of whole texts, without special tokens around them.

    Strings of added tokens are plain text (`plain`) or get the file's own ids.
    """

    def __init__(self, path: str, plain: bool = False):
        self.path, self.plain = path, plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        strings = [t["content"] for t in spec["added_tokens"] if t["content"]]
        # A token that is no special one keeps its id even where special ones are plain text.
        marked = strings if not plain else [t["content"] for t in spec["added_tokens"] if t["content"] and not t["special"]]
        self.added = re.compile("|".join(map(re.escape, marked))) if marked else None
        ranks = _ranks(spec)
        self.memo: dict[bytes, bytes] = {}
        self.held = 0
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.line_feed = ranks[b"\n"]
            self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        """The file as its own library reads it, for what the ranks do not cover."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.encode_special_tokens = self.plain
        return made

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or (self.added and self.added.search(text)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of many texts."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        alone = [self.fast is None or len(r) > LONG_BYTES or bool(self.added and self.added.search(t)) for t, r in zip(texts, raw)]
        joined = b"".join(r for r, a in zip(raw, alone) if not a)
        sizes = np.array([0 if a else len(r) for r, a in zip(raw, alone)], np.int64)
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(joined, np.uint8)
        starts = unit_starts(data, begins)
        if len(starts):
            first, which = equal_units(data, starts)
            ends = np.r_[starts[1:], len(data)]
            made = self._units([joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            flat = np.frombuffer(b"".join(made), np.uint32)
            each = np.fromiter(map(len, made), np.int64, len(made)) // 4
            n = each[which]
            upto = np.r_[0, np.cumsum(n)]
            ids = flat[np.arange(upto[-1]) + np.repeat((np.cumsum(each) - each)[which] - upto[:-1], n)]
        else:
            ids, upto = np.array([], np.uint32), np.zeros(1, np.int64)
        edges = upto[np.searchsorted(starts, np.r_[begins, len(data)])].tolist()
        return [self.ids(t) if a else ids[x:y] for t, a, x, y in zip(texts, alone, edges, edges[1:])]

    def _units(self, units: list[bytes]) -> list[bytes]:
        """Ids of different units, as bytes of unsigned 32-bit numbers."""
        made = list(map(self.memo.get, units))
        missing = [i for i, known in enumerate(made) if known is None]
        strings = [units[i].decode("utf-8", "surrogatepass") for i in missing]
        # A line feed between units without white space, but for a space in front, is cut off on both sides.
        plain = [u[0] not in WHITE and not INNER.search(u) or u[0] == " " and len(u) > 1 and not INNER.search(u, 1) for u in strings]
        at_once = self.fast.encode_to_numpy("\n".join(u for u, p in zip(strings, plain) if p), disallowed_special=()).astype(np.uint32)
        cuts = np.flatnonzero(at_once == self.line_feed)
        raw, spans = at_once.tobytes(), zip((4 * np.r_[0, cuts + 1]).tolist(), (4 * np.r_[cuts, len(at_once)]).tolist())
        for i, u, p in zip(missing, strings, plain):
            if p:
                a, b = next(spans)
                new = raw[a:b]
            else:
                new = self.fast.encode_to_numpy(u, disallowed_special=()).astype(np.uint32).tobytes()
            made[i] = self.memo[units[i]] = new
            self.held += ENTRY_BYTES + len(units[i]) + len(new)
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        return made

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id of a byte-level file; of signs outside its alphabet, their UTF-8."""
        byte = byte_alphabet()
        out = [b""] * (max(self.vocabulary.values()) + 1)
        for token, i in self.vocabulary.items():
            out[i] = b"".join(bytes([byte[c]]) if c in byte else c.encode() for c in token)
        return out

    @property
    def vocabulary(self) -> dict[str, int]:
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        return spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}


class PieceTokenizer:
    """Ids of whole texts by a piece model, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]

    def token_bytes(self) -> list[bytes]:
        m = self.model
        return [
            bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, m.id_to_piece(i)) for i in range(m.vocab_size()))
        ]


class TokenBytes:
    """Lengths and spelling of ids."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def spell(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        shift = self.starts[ids] - (np.cumsum(n) - n)
        return self.flat[np.arange(n.sum()) + np.repeat(shift, n)].tobytes()


@lru_cache(maxsize=4)
def byte_tokenizer(path: str, plain: bool = False) -> ByteTokenizer:
    """One tokenizer for all tasks of a worker."""
    return ByteTokenizer(path, plain)


@lru_cache(maxsize=2)
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)
