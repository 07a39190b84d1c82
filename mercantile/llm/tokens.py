"""Token ids of the public 50k byte-level vocabulary, computed inside tasks.

Ids are those of the ``tokenizers`` file.  The ``tiktoken`` file holds the same
vocabulary as ranks and its encoder is several times faster, so it encodes the
texts made of common Latin characters, where both split alike; any other text
goes through ``tokenizers``.  Files are found through the installed package
that carries them, on every worker; their names are parameters.
"""

from __future__ import annotations

import base64
import re

BPE_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_50k.tiktoken"
_plain = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ſ]*")
_loaded: dict[tuple[str, str], tuple] = {}


def _encoders(bpe_file: str, rank_file: str) -> tuple:
    if (bpe_file, rank_file) not in _loaded:
        import os

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        whole = Tokenizer.from_file(public_tokenizers.path(bpe_file))
        whole.encode_special_tokens = True
        with open(public_tokenizers.path(rank_file), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
        _loaded[bpe_file, rank_file] = (whole, fast)
    return _loaded[bpe_file, rank_file]


def encode(text: str | None, bpe_file: str = BPE_FILE, rank_file: str = RANK_FILE) -> list[int]:
    """Ids of a text without special tokens; NULL counts as empty."""
    if not text:
        return []
    whole, fast = _encoders(bpe_file, rank_file)
    if _plain.fullmatch(text):
        return fast.encode_ordinary(text)
    return whole.encode(text, add_special_tokens=False).ids
