"""Fast ids of a word-level BPE vocabulary file (lower case, word-end suffix), equal to those of its own tokenizer.

Words between ASCII white space are tokenized on their own, so their ids are kept in bounded dictionaries. A new word is cut
into the vocabulary's pre-tokens where a plain rule does that (printable ASCII; letters followed by ASCII punctuation); these
go through the same ranks in a byte-pair encoder with the word end as byte 1. Any other word goes to the tokenizer itself.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

_END = "\x01"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTABLE = re.compile(r"[!-~]+")
#: Sequences that the tokenizer may treat as one added token.
_ADDED = re.compile(r"<\|(?:start|end)oftext\|>", re.I)
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {}
    for token, i in vocab.items():
        if _ADDED.fullmatch(token):
            continue
        ends = token.endswith("</w>") and len(token) > 4
        ranks[bytes(of[c] for c in (token[:-4] if ends else token)) + (b"\x01" if ends else b"")] = i
    return ranks


class WordBpe:
    """``limit`` bounds each dictionary's entries, but for one text's words; a full one is emptied."""

    def __init__(self, path: str, limit: int = 300_000):
        import tiktoken
        from tokenizers import Tokenizer

        ranks = _ranks(path)
        self.limit, self.words, self.parts = limit, {}, {}
        self.own = tiktoken.Encoding("words", pat_str=f"[^{_END}]*{_END}", mergeable_ranks=ranks, special_tokens={})
        self.closes = np.zeros(max(ranks.values()) + 1, bool)
        self.closes[[i for b, i in ranks.items() if b.endswith(b"\x01")]] = True
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True

    def _cut(self, word: str) -> list[str] | None:
        """The word's pre-tokens, or None where only the tokenizer knows."""
        if _PRINTABLE.fullmatch(word):
            return None if _ADDED.search(word) else _ASCII.findall(word.lower())
        letters = word.rstrip(_PUNCTUATION)
        low = letters.lower()
        # A letter whose lower case has a mark would be cut there; a sigma's depends on its place.
        if letters.isalpha() and low.isalpha() and "Σ" not in letters and unicodedata.is_normalized("NFC", letters):
            return [low, word[len(letters) :]] if len(letters) < len(word) else [low]
        return None

    def _learn(self, new: set[bytes]) -> None:
        cut, odd = {}, []
        for w in new:
            text = w.decode("utf-8", "replace")
            parts = self._cut(text)
            if parts is None:
                odd.append((w, text))
            else:
                cut[w] = parts
        known = self.parts
        need = list({p for parts in cut.values() for p in parts if p not in known})
        for i in range(0, len(need), 5000):
            some = need[i : i + 5000]
            ids = np.array(self.own.encode_ordinary("".join([p + _END for p in some])), "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            if len(ends) != len(some):
                raise ValueError("a part of a word has no end in the vocabulary")
            raw, start = ids.tobytes(), 0
            for p, end in zip(some, ends.tolist(), strict=True):
                known[p] = raw[start:end]
                start = end
        for w, parts in cut.items():
            self.words[w] = b"".join([known[p] for p in parts])
        for (w, _), e in zip(odd, self.whole.encode_batch([t for _, t in odd], add_special_tokens=False), strict=True) if odd else ():
            self.words[w] = np.array(e.ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        words = text.encode("utf-8", "replace").split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            if len(self.words) > self.limit:
                self.words.clear()
            if len(self.parts) > self.limit:
                self.parts.clear()
            known = self.words
            self._learn({w for w in words if w not in known})
            return b"".join(map(self.words.__getitem__, words))
