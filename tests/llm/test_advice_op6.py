
import numpy as np
import pyarrow as pa
import xxhash

from tapewright.llm import quality_model


def test_op6_reads_words_whole():
    tokens = quality_model.Tokens(1 << 14)
    pairs = [("https://example.org/a/b/c", "https://example.org/a/b/d"), ("日本語の文章、ここから先は長い文です", "日本語の文章、ここから先は長い本です"), ("a" + "-" * 9 + "b", "a" + "-" * 9 + "c"), ("x" * 5_000 + "yz", "x" * 5_000 + "zy")]
    for a, b in pairs:
        t, sizes = tokens.of(pa.array([a, b]))
        assert t[: sizes[0]].tolist() != t[sizes[0] :].tolist()
    t, sizes = tokens.of(pa.array(["", None, "Word, word", "OK"]))
    assert sizes.tolist() == [0, 0, 3, 2] and t[0] == t[2]


def test_op6_shortcut_follows_the_rule():
    """Tokens of plain words by the shortcut and by the general rule, over scripts, signs, capitals and long words."""
    rng = np.random.default_rng(1)
    signs = list("aZ9_.,é日!İß٣½-\"')")
    words = {"".join(rng.choice(signs, rng.integers(1, 26))).encode() for _ in range(5_000)} | {b"Word,", b"OK", b"A", "ÉCOLE.".encode(), b"\xff\xfe"}
    for word in words:
        want, capitals = [], False
        for m in quality_model.RUNS.finditer(word.decode("utf-8", "replace")):
            run, kind = m[0].lower(), "w" if m[1] else "s"
            capitals |= len(m[0]) > 1 and m[0].isupper()
            parts = [run] if len(run) <= quality_model.LONGEST else [run[i : i + quality_model.GRAM] for i in range(len(run) - quality_model.GRAM + 1)]
            want += [xxhash.xxh3_64_intdigest((kind + x).encode("utf-8", "replace")) for x in parts]
        assert quality_model.token_hashes(word) == want + [quality_model.CAPITALS] * capitals
