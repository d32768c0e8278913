"""Token ids against the library as it comes, on texts that hold added tokens."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from satchel.llm import queries as q
from satchel.llm.tokens import encoder


@pytest.mark.parametrize(("file", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_ids_are_those_of_the_plain_library(file, kind):
    file = q.public_tokenizers.path(file)
    plain, mine = Tokenizer.from_file(file), encoder(file, kind)
    tokens = [x.content for x in plain.get_added_tokens_decoder().values()]
    random.seed(8)
    parts = [*tokens, *(x.upper() for x in tokens), *(x[:-1] for x in tokens), "a", "B ", " ", "\n", "é", "日", "<", "'s", "12", "."]
    texts = ["a <|endoftext|> b", *("".join(random.choices(parts, k=random.randint(1, 9))) for _ in range(2000))]
    for text in texts:
        want = np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert mine(text) == want, text
