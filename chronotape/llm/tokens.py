"""Token ids of a byte-level BPE vocabulary, for many texts in one task.

Texts repeat words far more than they repeat sentences, so each worker remembers the ids of the
space-separated chunks it has met. A chunk may be encoded alone only where the vocabulary's own
splitting pattern would split too: before a single space between two characters that are not white
space. Elsewhere (runs of white space) chunks stay together, so ids equal those of the whole text.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re

import numpy as np

#: Chunks one worker remembers, and the longest chunk worth remembering, in characters.
MEMORY, LONGEST = 300_000, 64
_RUN = re.compile(r"\s\s")
_LONE = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Little-endian unsigned 32-bit ids. ``ranks`` is the path of a vocabulary in rank form.

    ``added`` gives the ids of tokens that stand for themselves wherever a text holds them, as the
    vocabulary's own file declares; the text between them is encoded by itself.
    """

    def __init__(self, ranks: str, added: dict[str, int]) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self._known: dict[str, bytes] = {}
        self._added = {token: np.asarray([i], dtype="<u4").tobytes() for token, i in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self._marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None

    def _encode(self, text: str) -> bytes:
        return np.asarray(self._encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, added tokens included."""
        if not any(token in text for token in self._added):
            return self._plain(text)
        parts = self._marks.split(text)
        return b"".join(self._added.get(part) or self._plain(part) for part in parts if part)

    def _plain(self, text: str) -> bytes:
        chunks = _LONE.split(text) if _RUN.search(text) else text.split(" ")
        known, out = self._known, [self._encode(chunks[0])]
        for chunk in chunks[1:]:
            ids = known.get(chunk)
            if ids is None:
                ids = self._encode(" " + chunk)
                if len(known) < MEMORY and len(chunk) <= LONGEST:
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)


@functools.lru_cache(maxsize=1)
def encoder(ranks: str) -> Encoder:
    """One encoder per vocabulary and worker process; the same vocabulary's JSON file names its added tokens."""
    whole = f"{os.path.splitext(ranks)[0]}.json"
    added = []
    if os.path.exists(whole):
        with open(whole, encoding="utf-8") as file:
            added = json.load(file).get("added_tokens", [])
    return Encoder(ranks, {token["content"]: token["id"] for token in added})
