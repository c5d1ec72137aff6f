
import zlib

import numpy as np

from tapewright.llm import packing


def test_op4_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "  <|endoftext|>", "<|endoftext|", "<|ENDOFTEXT|> <|endoftext |>", "日本<|endoftext|>\n\n z "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in packing.packed(docs, with_ids=False).collect()}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert got[i]["doc_tokens"] == len(ids) and got[i]["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
