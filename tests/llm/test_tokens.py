import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from temblor.llm.tokens import TextEncoder
from tests.llm.conftest import ODD

HARD = [
    "", " ", "a  ", "a   b", "a\n b", " \n \n x", "it's 'S don't!'s", "É́cole ΑΣ ΟΔΟΣ.", "a\x1cb \x85 c d", "tab\t x  \t y",
    "x \r\n\r\n y", "１２３ ½ ²", "　wide   em", "İstanbul ǅ ﬁ", "🙂🙂 👍🏽 ok", "a" * 3000, "x\n", "\n\n x", "a '́s", "<|endoftext|>",
    "a <|endoftext|> b", "x  <|startoftext|><|endoftext|>  y\n <|endoftext|", "<|EndOfText|> <|endoftext|>'s é<|endoftext|>́",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("remembered", [400_000, 7])
def test_ids_are_those_of_the_library(spark, name, remembered):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    own = TextEncoder(public_tokenizers.path(name), remembered)
    for text in [*HARD, *(t or "" for _, t in ODD), *(r.text for r in real)]:
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want, text[:60]
