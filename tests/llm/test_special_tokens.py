"""Texts that hold an added token of the tokenizer."""

import numpy as np
from tokenizers import Tokenizer

from curate.llm.tokenization import Encoder, vocabulary_path


def test_added_tokens_are_coded_as_by_the_library():
    plain = Tokenizer.from_file(vocabulary_path())
    texts = [
        "a <|endoftext|> b", "<|endoftext|>", "word<|endoftext|>word  x\n", "<|endoftext", None,
        "é<|endoftext|><|endoftext|>\n\nz", "plain text.",
    ]
    got = Encoder(vocabulary_path()).encode(texts)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert 50256 in want[0]
