"""Helpers that test modules import."""

import os
import random

from rentscope.llm.queries import BYTE_BPE, BYTE_RANKS, PATTERN, tokenizer

TOKENIZER, RANKS = tokenizer(BYTE_BPE), tokenizer(BYTE_RANKS)


def unordered(found) -> list:
    return sorted((tuple(r) for r in found), key=repr)


def plain_tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(TOKENIZER)
    found.encode_special_tokens = True
    return found


def plain_tiktoken():
    import base64

    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = ["ba", "né", "ko", "lu", "shi", "tra", "öm", "ve"]
    out = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words)]
    return "".join(w + rng.choice([" ", " ", " ", ", ", ".\n"]) for w in out)


def edit(text: str, *places: int) -> str:
    words = text.split(" ")
    for place in places:
        words[place % len(words)] = f"edit{place}"
    return " ".join(words)
