"""Encode texts with the tokenizers library, each distinct segment once per task.

A text is cut only where the tokenizer provably cuts as well, so the ids of the whole text are the ids of its segments in order. Where
no such place is known for a tokenizer or a text, the text is encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

MEMO_ENTRIES = 1 << 19  # segments remembered per Python worker, some 100 MB; the memo starts anew beyond it
MEMO_CHARS = 64  # longer segments are encoded but not remembered
# Control characters that Python calls white space and the tokenizers' patterns do not.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_SPACED = re.compile(r"\s*\S+|\s+")
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SPACED_LETTERS = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+")
_ASCII_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


@lru_cache(maxsize=4)
def encoder(name: str) -> "SegmentEncoder":
    """The encoder of a vocabulary file of ``public_tokenizers``, or of a path; one per Python worker, so its memo serves many batches."""
    return SegmentEncoder(name if "/" in name else public_tokenizers.path(name))


def cut_kind(config: dict) -> str | None:
    """How texts may be cut for a tokenizer, from its configuration; None if no safe cut is known.

    * ``spaced``: byte-level pieces by the built-in pattern, no normalizer: no piece has a white-space character after a character of another kind, so
      every change from the one to the other is a cut;
    * ``words``: words found by a pattern that never matches white space, normalised character by character (NFC never joins across white space): white space
      is a cut and has no ids of its own.

    Both also cut between an ASCII letter and a full stop or comma.
    """
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in config["added_tokens"]):
        return None
    if config.get("post_processor") and config["post_processor"].get("type") not in ("ByteLevel", None):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True):
        return "spaced"
    kinds = [n["type"] for n in (norm or {}).get("normalizers", [])]
    parts = pre.get("pretokenizers", [])
    if kinds == ["NFC", "Replace", "Lowercase"] and norm["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and parts:
        split = parts[0]
        if [p["type"] for p in parts] == ["Split", "ByteLevel"] and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"] and split["invert"] and split["behavior"] == "Removed" and split["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+"):
            return "words"
    return None


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes with: printable bytes stand for themselves, the others for the characters from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class SegmentEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.cut = cut_kind(config)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo = _Memo(self.tokenizer, self.cut, self.kind)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each encoded in one piece."""
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian bytes of ``kind``."""
        if self.cut is None:
            return self.whole(texts)
        out = []
        for text in texts:
            if _ODD_SPACE.search(text):
                out += self.whole([text])
            else:
                out.append(b"".join(map(self.memo.__getitem__, text.split() if self.cut == "words" else _SPACED.findall(text))))
        return out


class _Memo(dict):
    """Segment -> ids as bytes, filled on demand.

    A segment that is one piece of letters, which neither case folding nor NFC turns into something else, goes to the vocabulary's model
    itself; every other one through the whole tokenizer.
    """

    def __init__(self, tokenizer: Tokenizer, cut: str | None, kind: np.dtype):
        self.tokenizer, self.kind, self.code = tokenizer, kind, "H" if kind.itemsize == 2 else "I"
        self.lower = cut == "words"  # its normalizer lowers case letter by letter
        self.piece = (_LETTERS if self.lower else _SPACED_LETTERS).fullmatch
        self.model = tokenizer.model.tokenize
        self.letters = _byte_letters()

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        if len(segment) > 1 and segment[-1] in ".," and segment[-2] in _ASCII_LETTERS:
            ids = self[segment[:-1]] + self[segment[-1]]  # a word and a final mark have ids of their own
        elif self.piece(segment):
            if self.lower and segment != (small := segment.lower()):
                ids = self[small]
            else:
                ids = array(self.code, [t.id for t in self.model(segment.encode().decode("latin-1").translate(self.letters))]).tobytes()
        else:
            ids = array(self.code, self.tokenizer.encode(segment, add_special_tokens=False).ids).tobytes()
        if len(segment) <= MEMO_CHARS:
            self[segment] = ids
        return ids
