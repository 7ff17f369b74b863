"""Token ids of many texts with a word-level BPE tokenizer, faster than text by text and equal to it.

Texts of printable ASCII and Latin-1 letters are lower-cased and cut into words here, by the tokenizer's own rule; each
distinct word goes through the tokenizer's merges once and is then looked up. All other texts go through the tokenizer as they are.
"""

from __future__ import annotations

import json
import re

import numpy as np
from tokenizers import Tokenizer

MOST_WORDS = 1 << 20
_PLAIN = re.compile(r"[\x20-\x7e\t-\r\xc0-\xff]*\Z")
# Fixed value: the tokenizer's word rule, for lower-case text of the characters above.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class _Numbers(dict):
    """Number of every word, given in the order of their first use."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class WordTokenizer:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        rules = json.load(open(path, encoding="utf-8"))
        rules["normalizer"], rules["added_tokens"] = None, []
        rules["pre_tokenizer"] = {
            "type": "Sequence",
            "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}],
        }
        self.words = Tokenizer.from_str(json.dumps(rules))
        self.special = [t["content"] for t in json.load(open(path, encoding="utf-8")).get("added_tokens", [])]
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.size = np.zeros(0, np.int64)
        self.place = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self) -> None:
        fresh = self.numbers.fresh
        if not fresh:
            return
        sizes, ids = [self.size], [self.ids]
        for a in range(0, len(fresh), 4096):
            part = fresh[a : a + 4096]
            coded = self.words.encode("\n".join(part), add_special_tokens=False)
            ids.append(np.array(coded.ids, np.uint32))
            sizes.append(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(part)))
        self.size, self.ids = np.concatenate(sizes), np.concatenate(ids)
        self.place = np.cumsum(self.size) - self.size
        self.numbers.fresh = []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, as `encode` of the tokenizer without special tokens gives them."""
        if len(self.numbers) > MOST_WORDS:
            self._forget()
        numbered: list[np.ndarray | None] = []
        for text in texts:
            if _PLAIN.match(text) and not any(s in text for s in self.special):
                words = _WORD.findall(text.lower())
                numbered.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
            else:
                numbered.append(None)
        self._learn()
        out = []
        for text, n in zip(texts, numbered):
            if n is None:
                out.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            size = self.size[n]
            ends = np.cumsum(size)
            out.append(self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.place[n] - ends + size, size)])
        return out
