"""Long texts without spaces are spliced too."""

import random

import public_tokenizers

from loomspark.llm import token_counts
from loomspark.llm.units import library

WORDS = public_tokenizers.path("word_bpe_49k.json")


class Counting:
    """The library, with the longest text that it was given."""

    def __init__(self):
        self.lib, self.longest = library(WORDS), 0

    def encode(self, text, **options):
        self.longest = max(self.longest, len(text))
        return self.lib.encode(text, **options)


def test_texts_without_spaces():
    rng = random.Random(4)
    for _ in range(6):
        text = "".join(rng.choice("，。！「」") if rng.random() < 0.05 else chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000))
        lib = Counting()
        assert token_counts.long_ids(lib, text, 400, 60) == lib.lib.encode(text, add_special_tokens=False).ids
        assert lib.longest < 2000
