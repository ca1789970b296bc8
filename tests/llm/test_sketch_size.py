"""What is kept and moved of a sketch."""

import numpy as np

from parley.llm import chunks, fast_similarity as fs
from tests.llm import brute


def test_a_sketch_is_a_byte_a_bin(spark):
    """Also of large sets, whose least values all begin with zeros, the byte tells sets apart."""
    texts = [" ".join(f"{name}{i}" for i in range(60_000)) for name in "ab"]
    docs = brute.frame(spark, list(enumerate(texts)))
    packed, _ = chunks.chunked(docs.select("doc_id", "text"), "text")
    kept = [r["sketch"] for r in fs.sketched(packed, "text", fs.SHINGLE, "long").collect()]
    assert [len(x) for x in kept] == [fs.COORDINATES] * 2
    one, two = (np.frombuffer(x, np.uint8) for x in kept)
    assert (one == two).sum() < 10 and len(np.unique(one)) > 60
