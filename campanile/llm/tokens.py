"""Fast, exact tokenizing with files of the ``tokenizers`` library.

``PieceTokenizer(text of the file)`` gives the ids of ``encode(text, add_special_tokens=False)`` for tokenizers
that drop white space: no token spans ASCII white space there, so a text's ids are those of its pieces
between white space, in order. Each Python worker keeps the ids of pieces it has met, up to a bounded number.

A byte-level BPE with word ends is run by ``tiktoken``'s merge loop, which applies the same merges in the
same order several times faster: a word's last byte gets a mark that no UTF-8 text holds, and the merge
of a byte with that mark comes before all others. Pieces with letters beyond Latin go to the library itself.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np

_loaded: dict[int, PieceTokenizer] = {}
#: The split pattern of the fast path's tokenizers, as their files give it.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Beyond this code point pieces take the slow path.
LATIN = 0x24F


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    shown |= {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return {c: b for b, c in shown.items()}


class PieceTokenizer:
    """keep: ids are kept of the last so many new pieces, or up to twice as many."""

    def __init__(self, source: str, keep: int = 300_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model, self.keep = Tokenizer.from_str(source), keep
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.narrow = self.model.get_vocab_size() <= 1 << 16
        self.quick = self._quick(json.loads(source))

    def _quick(self, spec: dict):
        """A function from a piece to its ids for the known kind of file, else None."""
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        if model.get("type") != "BPE" or not suffix or steps != ["NFC", "Replace", "Lowercase"] or split[:1] != [WORD_SPLIT]:
            return None
        try:
            import regex
            from tiktoken import Encoding
        except ImportError:
            return None
        letters, end = byte_letters(), b"\xff"

        def as_bytes(token: str) -> bytes:
            return bytes(map(letters.__getitem__, token.removesuffix(suffix))) + end * token.endswith(suffix)

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranks = {bytes([b, 255]): b for b in range(256)} | {bytes([b]): 256 + b for b in range(256)}
        for a, b in merges:
            ranks.setdefault(as_bytes(a)[: -1 if a.endswith(suffix) else None] + as_bytes(b), len(ranks))
        ids = [model["vocab"].get(t) for t in (*(c + suffix for _, c in sorted((b, c) for c, b in letters.items())), *(c for _, c in sorted((b, c) for c, b in letters.items())))]
        ids += [model["vocab"].get(a.removesuffix(suffix) + b) for a, b in merges]
        if None in ids or len(ids) != len(ranks) or ids[512:] != sorted(ids[512:]) or max(ids[:512]) > min(ids[512:]):
            return None
        ranks = dict(zip(ranks, ids, strict=True))  # ids rise in the order of merges, so they can be the ranks
        core = getattr(Encoding("piece", pat_str="x", mergeable_ranks=ranks, special_tokens={}), "_core_bpe", None)
        if (merge := getattr(core, "encode_single_piece", None)) is None:  # without the library's merge loop, its way is not to be had
            return None
        parts = regex.compile(WORD_SPLIT).findall
        special = [t["content"] for t in spec.get("added_tokens", [])]
        odd = re.compile("|".join([f"[^\\x00-{chr(LATIN)}]", "[\\x1c-\\x1f]", *map(re.escape, special)])).search

        def quick(piece: str) -> list[int] | None:
            if piece.isascii():
                low = piece.lower()
                if low.isalpha():
                    return merge(low.encode() + end)
                if odd(piece):
                    return None
            elif odd(piece):
                return None
            else:
                low = unicodedata.normalize("NFC", piece).lower()
                if low.isalpha():
                    return merge(low.encode() + end)
            body = low.rstrip(".,")
            if body.isalpha():
                return merge(body.encode() + end) + merge(low[len(body) :].encode() + end)
            return [i for part in parts(low) for i in merge(part.encode() + end)]

        return quick

    def _ids(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        got = self.quick(text) if self.quick else None
        return array("I", self.model.encode(text, add_special_tokens=False).ids if got is None else got).tobytes()

    def encode(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text, each as a little-endian unsigned 32-bit integer."""
        pieces = text.split()
        try:
            return b"".join(map(self.kept.__getitem__, pieces))
        except KeyError:
            pass
        if len(self.kept) >= self.keep:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        for p in set(pieces).difference(kept):
            kept[p] = older.get(p) or self._ids(p)
        return b"".join(map(kept.__getitem__, pieces))


def tokenizer(source: str) -> PieceTokenizer:
    """This worker's tokenizer for a file's text."""
    key = hash(source)
    if key not in _loaded:
        _loaded[key] = PieceTokenizer(source)
    return _loaded[key]
