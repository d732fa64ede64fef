"""Token ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import json
import re

# Code points whose class is the same in every Unicode version the two
# libraries may use; texts with others go to the reference library.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
_LONG = 200_000


class Encoder:
    """Ids as the `tokenizers` library gives them for a tokenizer file; the
    string of a special token in a text is that token, as the library has it.

    For byte-level BPE files most texts are encoded by `tiktoken` from the same
    merges, which gives the same ids several times as fast; texts outside plain
    Latin letters, with special tokens' strings, or very long ones are encoded
    by `tokenizers` itself.
    """

    def __init__(self, content: str):
        self.content = content
        self.fast = _merges(content)
        self.added = tuple(t["content"] for t in json.loads(content).get("added_tokens", []))
        self._slow = None

    @property
    def slow(self):
        """The reference encoder, loaded for the first text that needs it."""
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_str(self.content)
        return self._slow

    def encode(self, text: str) -> list[int]:
        if (self.fast is not None and len(text) < _LONG and not any(t in text for t in self.added)
                and _PLAIN.fullmatch(text)):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def _merges(content: str):
    """The file's vocabulary for `tiktoken`, or None if it isn't plain byte-level BPE."""
    import tiktoken
    spec = json.loads(content)
    pre = spec.get("pre_tokenizer") or {}
    if (spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer")
            or pre.get("add_prefix_space") or not pre.get("use_regex", True)):
        return None
    import public_tokenizers
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes shown as themselves
    byte_of = {chr(b): b for b in shown}
    byte_of.update({chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in set(shown))})
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
