"""The public byte-level BPE vocabulary, loaded once per Python worker from a file that is a parameter."""
from __future__ import annotations

import base64
import functools

#: File names of the vocabulary; a full path may be given instead.
RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT = "<|endoftext|>"


@functools.lru_cache(maxsize=4)
def encoder(ranks: str = RANKS):
    """A tiktoken encoding with the same ids as the ``tokenizers`` file of the vocabulary.

    The two are compared in the tests, character by character over all of
    Unicode and on whole documents; this one is several times faster.
    """
    import os

    import public_tokenizers
    import tiktoken

    path = ranks if os.path.isabs(ranks) else public_tokenizers.path(ranks)
    with open(path, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                             special_tokens={END_OF_TEXT: len(merges)})
