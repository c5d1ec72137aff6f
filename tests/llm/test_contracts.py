"""Each operator's query or operator against a brute-force version, on small tables."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.functions import expr as F_expr

from tapewright.llm import exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, pii, quality_model, quality_rules, queries, warc

SF = "/root/testdata/sf0.01"
KINDS = ["email", "ip", "card", "phone"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One TWO"), (5, "One TWO"), (6, "é ß 日本 " * 30), (None, "id less text"), (7, "x" * 50_000),
    (8, "a@b.c_d@e.f %x@y.z a@b@c.d 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.0400 4111 1111-1111 1111 +1 (743) 555-3824. +12 5 a..b@c..d u@v.w-"),
    (9, "9" * 20_000), (10, "1.2." * 5_000), (11, "a." * 9_000 + "@x.y"), (12, "call (743) 555-3824 now"), (13, "日本 mail ann(at)host9(dot)org, +1 743 555 3824"),
    (14, "\n".join(["the same line of text"] * 4)), (15, "é" * 10 + "@é.c x@y.zé"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None, 5, "clash", b"clash", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep_id string, sig binary, id int")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in zip(KINDS, [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"], strict=True):
        for m in re.finditer(pattern, text or ""):
            s = m[0]
            n = re.sub("[^0-9]", "", s)
            checks = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in s.split(".")), "card": lambda: 12 <= len(n) <= 19 and luhn(n), "phone": lambda: 9 <= len(n) <= 15}
            if checks[kind]():
                out.append((m.start(), KINDS.index(kind), m.end()))
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_op1(spark, odd, empty, texts):
    found = {r["doc_id"]: r for r in queries.op1_pii(spark, SF).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        base = brute_pii(text)
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), i
        assert set(base) <= set(found[i]["spans"].split(",")) or not base
        assert [found[i][f"n_{k}"] for k in KINDS] == [sum(x.startswith(k) for x in base) for k in KINDS]
    from pyspark.sql import functions as F

    rows = pii.find(odd).select("doc_id", "text", F.expr(pii.span_text("base")).alias("b"), F.expr(pii.span_text("spans")).alias("s")).collect()
    assert len(rows) == len(ODD)
    slow = {11}  # the plain pattern takes quadratic time there
    for r in rows:
        if r["doc_id"] not in slow:
            assert r["b"] == ",".join(brute_pii(r["text"])), r["doc_id"]
    spans = {r["doc_id"]: r["s"] for r in rows}
    assert spans[12] == "phone:5:19" and spans[13].startswith("email:8:28,")
    assert "[phone]" in {r["doc_id"]: r["text"] for r in pii.redacted(odd).collect()}[12]
    assert pii.find(empty).count() == 0


def test_op1_unseen_phrases(spark):
    """Added spans on phrases and formats of no template: what is personal is found, what only looks like it is left."""
    personal = ["Give me a ring: (415) 555-0134 after six", "My telephone 415-555-0134 is new", "You may mail sue[at]garden[dot]org any day", "contact BOB AT EXAMPLE DOT COM please", "the client 2001:db8::8a2e:370:7334 was seen.", "server at fe80:0000:0000:0000:0202:b3ff:fe1e:8329."]
    plain = ["order number 415-555-0134 has shipped", "section 10 200 3000 of the report", "we sat at home.Then it rained", "the clock showed 10:20:30:40", "include std::vector and Foo::Bar here", "serial 1234.5678.9012.3456 on the back", "a total of 12 345 678 km"]
    docs = spark.createDataFrame(list(enumerate(personal + plain)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in pii.find(docs).select("doc_id", F_expr(pii.span_text("spans")).alias("s")).collect()}
    assert sum(bool(got[i]) for i in range(len(personal))) >= len(personal) - 1, got
    assert sum(bool(got[len(personal) + i]) for i in range(len(plain))) <= 1, got


def test_op1_many_matches(spark):
    """Places stay exact over chunks, and a text with very many matches takes seconds."""
    import time

    words = [f"u{i}@h{i % 7}.org" if i % 3 else f"call (415) 555-{i % 10000:04d}" for i in range(20_000)]
    text = " é ".join(words)
    start = time.time()
    row = pii.find(spark.createDataFrame([(1, text), (2, " ".join(["1.2.3.4"] * 700))], "doc_id long, text string")).select("doc_id", F_expr(pii.span_text("base")).alias("b"), F_expr("size(spans)").alias("n")).collect()
    assert time.time() - start < 60
    by = {r["doc_id"]: r for r in row}
    assert by[1]["b"] == ",".join(brute_pii(text)) and by[1]["n"] == len(words)
    assert by[2]["b"] == ",".join(brute_pii(" ".join(["1.2.3.4"] * 700)))


def test_op2(spark, odd, empty, texts):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(t or "", []).append(i)
    for r in queries.op2_exact_dedup(spark, SF).collect():
        g = groups[texts[r["doc_id"]] or ""]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), r["doc_id"] == max(g))
        assert r["text_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    rows = exact_dedup.exact_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["keep_id"] == 2 and by[1]["group_size"] == 2 and not by[1]["kept"] and by[None]["kept"]
    assert sorted(r["kept"] for r in rows if r["doc_id"] == 5) == [False, True]  # one of two equal rows
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_op2_state_over_many_batches(spark):
    rows = spark.createDataFrame([(i, f"t{i % 7}") for i in range(200)], "doc_id long, text string").repartition(6)
    out = exact_dedup.exact_duplicates(rows, p=exact_dedup.Params(files_per_batch=1, broadcast_digests=0)).collect()
    for r in out:
        same = [i for i in range(200) if i % 7 == r["doc_id"] % 7]
        assert r["keep_id"] == max(same) and r["group_size"] == len(same)


def test_op3(spark, odd, empty):
    docs = [(1, "a b\nc d\nfirst\n\nz"), (2, "x\na b\nc d\ny"), (3, "c d\nq\na b\nc d"), (4, "y\nx"), (5, " ".join(["w"] * 60)), (6, "k\n" + " ".join(["w"] * 60) + "\nl"), (7, None)]
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[1]["n_removed"] == 0 and out[2]["text"] == "x\ny" and out[3]["text"] == "c d\nq" and out[4]["text"] == "y\nx"
    assert out[5]["n_removed"] == 0 and out[6]["text"] == "k\nl" and out[6]["n_runs"] == 1 and out[7]["n_lines"] == 0
    rows = line_dedup.line_dedup(odd).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows}[14] == 3 and len(rows) >= len(ODD)
    assert line_dedup.line_dedup(empty).count() == 0


def brute_lines(docs, window, heavy):
    """Lines that go, by comparing every window with all earlier ones: (id, text) -> set of line numbers."""
    seen, gone = {}, {}
    for i, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0])):
        lines = [(n, x.strip(" ")) for n, x in enumerate((text or "").split("\n")) if re.search(r"[^\x20\t-\r]", x)]
        spans = [(lines[k][0], lines[k + window - 1][0], tuple(x for _, x in lines[k : k + window])) for k in range(len(lines) - window + 1)]
        spans += [(n, n, (x, None)) for n, x in lines if len([w for w in re.split(r"[\x20\t-\r]+", x) if w]) >= heavy]
        own = set()
        for first, last, key in sorted(spans, key=lambda x: x[:2]):
            if seen.setdefault(key, (i, first)) != (i, first):
                own |= set(range(first, last + 1))
        gone[i, text] = own
    return gone


def test_op3_against_all_windows(spark):
    """Random documents of few different lines, repeated ids, blank lines between, windows of several lengths."""
    rng = np.random.default_rng(11)
    line = ["", "  ", *(f"line {i}" for i in range(14)), " line 3 ", " ".join(["w"] * 6), " ".join(["v"] * 7)]
    docs = [(int(rng.integers(0, 40)), "\n".join(line[j] for j in rng.integers(0, len(line), rng.integers(0, 25)))) for _ in range(60)]
    docs = [(i, t) for i, t in {i: t for i, t in docs}.items()]
    docs += [(docs[0][0], docs[0][1]), (1000, None), (1001, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for window in (2, 3, 5):
        want = brute_lines(docs, window, 6)
        for r in line_dedup.line_dedup(table, p=line_dedup.Params(window=window, heavy_words=6)).collect():
            text = next(t for i, t in docs if i == r["doc_id"]) or ""
            rest = [x for n, x in enumerate(text.split("\n")) if n not in want[r["doc_id"], text or (None if r["doc_id"] == 1000 else "")]]
            assert r["text"] == "\n".join(rest) and r["n_removed"] == len(want[r["doc_id"], text or (None if r["doc_id"] == 1000 else "")])


def test_op3_repeated_ids_and_long_texts(spark):
    docs = [(1, "a b\nc d\nz"), (5, "a b\nc d\nend"), (5, "unique one\nunique two\nunique three"), (None, "a b\nc d"), (7, "\n".join(f"line {i % 30_000}" for i in range(40_000))), (8, "\n".join(["x y"] * 40_000))]
    out = {(r["doc_id"], r["text"][:10]): r for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[None, "a b\nc d"]["n_removed"] == 0 and out[1, "z"]["n_removed"] == 2 and out[5, "end"]["n_removed"] == 2 and out[5, "unique one"]["n_removed"] == 0
    long = out[7, "line 0\nlin"]
    assert long["n_removed"] == 10_000 and [tuple(x) for x in long["runs"]] == [(30_000, 39_999, 7, 0)]
    assert out[8, "x y"]["n_removed"] == 39_999


def test_op4(spark, docs, odd, empty, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op4_packing(spark, SF).collect()
    some = sorted(texts)
    ids = {i: [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1] for i in some}
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, own in by.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
            if i in ids:
                assert r["ids_crc32"] == zlib.crc32(np.array(ids[i][r["start"] : at], dtype="<u4").tobytes())
        assert at == own[0]["doc_tokens"]
    used = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and {r["padded_length"] for r in own} == {at if at & (at - 1) == 0 else 2048}
        used += at
    assert used / (2048 * len(sequences)) > 0.99
    got = packing.packed(odd).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 2) == 1 and all(len(r["ids"]) == 4 * r["length"] for r in got)
    assert {r["doc_id"] for r in packing.packed(odd, with_ids=False).collect()} == {i for i, _ in ODD}
    assert packing.packed(empty).count() == 0


def test_first_fit_decreasing():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins: list[list[int]] = []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            for b in bins:
                if sum(lengths[j] for j in b) + lengths[i] <= 100:
                    b.append(i)
                    break
            else:
                bins.append([i])
        assert packing.first_fit_decreasing(lengths, 100) == bins


def brute_near(texts, k, percent):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    for i in ids:
        common = {}
        for s in sets[i]:
            for j in where[s]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_op5(spark, odd, empty, texts):
    want = brute_near(texts.items(), 2, 80)
    got = {r["doc_id"]: r for r in queries.op5_near_dedup(spark, SF).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and {r["doc_id"]: r["component_id"] for r in rows}[1] == 1
    assert near_dedup.near_duplicates(empty).count() == 0


def test_op5_chains_and_hot_groups(spark):
    """Copies that differ in a few words each, so that many pairs are near the limit and components are chains."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 500, 120)]
    rows = []
    for i in range(400):
        words = list(base) if i % 3 else [f"v{x}" for x in rng.integers(0, 80, 40)]
        for at in rng.integers(0, len(words), rng.integers(0, 9)):
            words[at] = f"n{i}_{at}"
        rows.append((i, " ".join(words)))
    want = brute_near(rows, 2, 80)
    p = near_dedup.Params(shingle_words=2, broadcast_ids=0, broadcast_rows=0, block_rows=7, block_shingles=900)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), p=p).collect()}
    assert got == want


def test_op6(spark, odd, empty):
    rows = {r["doc_id"]: r for r in queries.op6_quality_model(spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(rows[i]["score"], y) for i, y in labels.items() if rows[i]["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.9 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    from pyspark.sql import functions as F

    few = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    out = quality_model.score(odd, few, F.lit(False), p=quality_model.Params(epochs=2)).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    assert quality_model.score(empty, few.where("false"), F.lit(False)).count() == 0


def test_op7(spark, docs, odd, empty):
    out = mixing.mix(docs, p=mixing.Params(flatten=0.5, keep_share=0.5, sweeps=12)).toPandas()
    tokens = out["n_tokens"] * out["probability"]
    assert abs(tokens.sum() / out["n_tokens"].sum() - 0.5) < 0.02 and out["probability"].between(0, 1).all()
    for margin in ("source", "lang", "topic"):  # the rarer a category, the likelier its documents
        rate = out.groupby(margin).agg(n=("n_tokens", "sum"), p=("probability", "mean"))
        assert rate.loc[rate["n"].idxmin(), "p"] >= rate.loc[rate["n"].idxmax(), "p"]
    assert len(mixing.mix(odd).collect()) == len(ODD) and mixing.mix(empty).count() == 0


def brute_raked(cells, p):
    """The same rule in plain numpy over cells {(source, lang, topic): tokens}."""
    keys, tokens = list(cells), np.array(list(cells.values()), dtype=float)
    cap, w, targets = tokens / (p.keep_share * tokens.sum()), tokens / tokens.sum(), []
    of = [[sorted({k[m] for k in keys}, key=str).index(k[m]) for k in keys] for m in range(3)]
    for m in range(3):
        mass = np.bincount(of[m], weights=tokens) ** p.flatten
        targets.append(mass / mass.sum())
    for _ in range(p.sweeps):
        for m in range(3):
            w = np.minimum(cap, w * (targets[m] / np.bincount(of[m], weights=w))[of[m]])
    for _ in range(2):
        free = w < cap
        w = np.minimum(cap, np.where(free, w * (1 + (1 - w.sum()) / max(w[free].sum(), 1e-300)), w))
    return dict(zip(keys, np.minimum(1, w / cap), strict=True))


def test_op7_meets_its_margins(spark):
    """Attainable targets are met, none takes more than there is, and both ways to sum agree with plain numpy."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 40))), [None, "web", "web", "web", "book", "wiki"][rng.integers(0, 6)], "en" if rng.random() < 0.7 else ["de", "fr", None][rng.integers(0, 3)], "ab"[int(rng.random() < 0.2)]) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, subject string")
    cells = {}
    for _, t, *key in rows:
        cells[tuple(key)] = cells.get(tuple(key), 0) + len(t.split())
    for p in (mixing.Params(keep_share=0.4, sweeps=20), mixing.Params(keep_share=0.8, flatten=0.3), mixing.Params(keep_share=0.8, flatten=0.3, window_cells=0, sweeps=2)):
        out = mixing.mix(docs, topic_col="subject", p=p)
        got = out.collect()
        want = brute_raked(cells, p)
        assert all(abs(r["probability"] - want[r["source"], r["lang"], r["topic"]]) < 1e-8 for r in got)
        report = mixing.margins(out, p).collect()
        if p.keep_share == 0.4:
            assert all(r["met"] for r in report)
        elif p.sweeps > 2:
            assert not all(r["met"] for r in report)
            assert abs(sum(r["n_tokens"] * r["probability"] for r in got) - 0.8 * sum(cells.values())) < 0.01 * sum(cells.values())


def test_op7_null_ids_have_draws_of_their_own(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "s", "en") for i in range(400)], "doc_id long, text string, source string, lang string")
    assert 0.7 < sum(r["sampled"] for r in mixing.mix(docs).collect()) / 400 < 0.9


def test_op8(spark):
    pages = [(1, "http://a/x y", "x" * 2000), (2, None, "x" * 2000), (3, "http://ü/", "\r\n\r\nWARC/1.1\r\n" * 100), (4, "u", None), (5, "u", ""), (None, "n", "x" * 2000), (6, "s", "x" * 999), (7, "s", "x" * 999), (8, "b", "\n"), (1, "http://a/x y", "x" * 2000)]
    table = spark.createDataFrame([(*r, "clash") for r in pages], "page_id long, url string, html string, payload string")
    rows = warc.convert_pages(table, with_payload=True).collect()
    assert len(rows) == len(pages) and all(r["digest_ok"] for r in rows)
    by = {r["page_id"]: r for r in rows}
    assert by[1]["record_type"] == "revisit" and by[1]["refers_to"] == 2 and by[1]["payload_bytes"] == 2000 and by[2]["record_type"] == "response"
    assert by[3]["payload"] == ("\r\n\r\nWARC/1.1\r\n" * 100).encode() and by[3]["target"] == "http://%C3%BC/" and by[8]["payload"] == b"\n"
    assert by[6]["record_type"] == "response" and (by[None]["record_type"], by[None]["refers_to"]) == ("revisit", 2) and by[4]["payload_digest"] == warc.EMPTY_SHA1
    assert warc.convert_pages(table.where("false")).count() == 0
    shuffled = {r["page_id"]: r["refers_to"] for r in warc.convert_pages(table, p=warc.Params(broadcast_groups=0)).collect()}
    assert shuffled == {r["page_id"]: r["refers_to"] for r in rows}


def test_op8_long_lines_lose_nothing(spark):
    pages = [(1, "http://a/" + "u" * 1_200_000, "one"), (2, "b", "two"), (3, "c", "x" * 3_000_000 + "\n" * 1_000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    rows = {r["page_id"]: r for r in warc.convert_pages(table, with_payload=True).collect()}
    assert {i: r["payload"].decode() for i, r in rows.items()} == {i: t for i, _, t in pages} and rows[1]["target"] == pages[0][1]


def test_op8_all_ids_null(spark):
    table = spark.createDataFrame([(None, "a", "x" * 2_000), (None, "b", "x" * 2_000)], "page_id long, url string, html string")
    assert [(r["record_type"], r["refers_to"]) for r in warc.convert_pages(table).collect()] == [("response", None)] * 2


def test_arc_versions_and_faults():
    import io

    for version in (1, 2):
        good = warc.arc_version_block(version, "20240102030405") + warc.arc_record("http://a", b"pay\n\nload", version, "20240102030405", 5)
        (r,) = warc.parse_arc(io.BytesIO(good))
        assert r["payload"] == b"pay\n\nload" and warc.warc_date(r["header"]["Archive-date"]) == "2024-01-02T03:04:05Z"
        assert list(warc.parse_arc(io.BytesIO(good[:-4])))[-1]["error"] == "content cut short"
        assert list(warc.parse_arc(io.BytesIO(good + b"bad line\n")))[-1]["error"] == "header line does not fit the version"
    assert next(warc.parse_arc(io.BytesIO(b"x\n")))["error"] == "no version block"


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_op9(spark, odd, empty, texts):
    rows = {r["doc_id"]: r for r in queries.op9_quality_rules(spark, SF).collect()}
    for i in sorted(texts)[::5]:
        if len(texts[i] or "") < 8_000:
            r = rows[i]
            assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_rules(texts[i])
    out = quality_rules.judge(odd).collect()
    assert len(out) == len(ODD) and quality_rules.judge(empty).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_op9_verdict_by_brute_force(spark):
    """Covered fraction, longest repeat and verdict against all pairs of places in a text."""
    rng = np.random.default_rng(6)
    rules = quality_rules.Rules()
    texts = []
    for _ in range(40):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(55, 120))]
        for _ in range(rng.integers(0, 3)):
            a, n, b = rng.integers(0, 40), rng.integers(8, 40), rng.integers(0, len(words))
            words[b:b] = words[a : a + n]
        texts.append(" ".join(words))
    rows = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        words = text.split()
        n, covered, longest = len(words), set(), 0
        for a in range(n):
            for b in range(a + 1, n):
                k = 0
                while b + k < n and words[a + k] == words[b + k]:
                    k += 1
                longest = max(longest, k)
                if k >= rules.min_repeat_words:
                    covered |= set(range(a, a + k)) | set(range(b, b + k))
        share = len(covered) / n
        bad = brute_rules(text)[5] or share > rules.max_covered_fraction or (longest >= rules.longest_floor_words and longest > rules.max_longest_fraction * n)
        assert abs(rows[i]["covered_fraction"] - share) < 1e-12 and rows[i]["longest_repeat"] == longest and rows[i]["kept"] == (not bad)


def test_op6_and_op10_equal_rows_score_alike(spark):
    from pyspark.sql import functions as F

    rows = [(i % 40, f"good words number {i % 40} are here to be read" if i % 2 else f"BUY!!! now {i % 40} $$$", "en" if i % 2 else "xx") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    scored = quality_model.score(docs, labels, F.lit(False), p=quality_model.Params(epochs=5)).collect()
    named = language_id.predict(docs, F.lit(False)).collect()
    assert len(scored) == len(named) == 80
    for got in (scored, named):
        assert len({tuple(r) for r in got}) == 40  # equal rows, equal results
    # A tie between languages goes to the first one in order.
    same = spark.createDataFrame([(1, "abc abd", "b"), (2, "abc abd", "a"), (3, "abc", None)], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(same, F.lit(False)).collect()} == {1: "a", 2: "a", 3: "a"}


def test_suffix_array_repeats():
    rng = np.random.default_rng(2)
    for _ in range(200):
        words = rng.integers(0, rng.integers(2, 9), rng.integers(1, 60))
        n = len(words)
        want = np.zeros(n, dtype=int)
        for i in range(n):
            for j in range(n):
                k = 0
                while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                want[i] = max(want[i], k)
        assert (quality_rules.repeated_prefixes(quality_rules.suffix_ranks(words, np.full(n, n))) == want).all()


def test_op10(spark, odd, empty, docs):
    rows = {r["doc_id"]: r for r in queries.op10_language_id(spark, SF).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in rows.items() if r["held_out"]]
    assert np.mean([rows[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    from pyspark.sql import functions as F

    out = language_id.predict(odd, F.lit(False)).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(ODD) and by[1]["lang_pred"] == "und" and by[9]["lang_pred"] == "und" and by[4]["lang_pred"] == "en"
    assert language_id.predict(empty, F.lit(False)).count() == 0


def test_kneser_ney_sums_to_one():
    words = [b"abab", b"abc", b"cab", b"bca", b"aab"]
    code, _ = language_id.grams(words)
    kinds, n = np.unique(code, return_counts=True)
    model = language_id.build(["x"], [(kinds, n)])
    for context in np.unique(code >> np.uint64(16))[:5]:
        p = np.exp(model.logs((context << np.uint64(16)) + np.arange(1 << 16, dtype=np.uint64)))
        assert abs(p.sum() - 1) < 1e-9


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {i: r for i, r in docs.items() if quality_rules.measure(pa.array([r["text"]]), quality_rules.Rules())["kept"][0]}
    last = {}
    for i, r in good.items():
        last[r["text"]] = max(i, last.get(r["text"], i))
    unique = {i: r for i, r in good.items() if last[r["text"]] == i}
    near = brute_near([(i, r["text"]) for i, r in unique.items()], 5, 80)
    kept = spark.createDataFrame([docs[i] for i, (_, c) in near.items() if i == c])
    chosen = {r["doc_id"] for r in mixing.mix(kept).where("sampled").collect()}
    assert {r["doc_id"] for r in out} == chosen and 0.5 < len(chosen) / kept.count() <= 1


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, repeated rows, null texts, empty tables, clashing names: of equal texts one row stays, of a near group one."""
    import corpus_pipeline

    rng = np.random.default_rng(9)
    long = [" ".join(f"{c}{x}" for x in rng.integers(0, 500, 120)) for c in "abcdef"]
    near = long[3].replace(long[3].split()[60], "changed", 1)
    rows = [
        (None, long[0]), (1, long[0]), (None, long[1]), (2, long[2]), (2, long[2]), (None, long[2]), (3, long[3]), (4, near), (5, long[4]), (5, long[5]), (6, long[5]), (None, long[1]), (7, None), (8, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 0, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, hash string, key int, c0 string").repartition(3)
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    good = corpus_pipeline.quality(spark, docs, "")
    assert pairs(good) == sorted([x for x in rows if x[1]], key=str) and good.columns == docs.columns
    exact = corpus_pipeline.exact(spark, good, "")
    assert pairs(exact) == sorted([(1, long[0]), (None, long[1]), (2, long[2]), (3, long[3]), (4, near), (5, long[4]), (6, long[5])], key=str) and exact.columns == docs.columns
    some = docs.where("text is not null and text <> ''")
    assert len(pairs(corpus_pipeline.near(spark, some, ""))) < len(pairs(some))
    kept = pairs(corpus_pipeline.near(spark, exact, ""))
    assert kept == sorted([(1, long[0]), (None, long[1]), (2, long[2]), (3, long[3]), (5, long[4]), (6, long[5])], key=str)
    twice = docs.where("doc_id = 5")  # two texts of one id are one group
    assert len(pairs(corpus_pipeline.near(spark, twice, ""))) == 1
    mixed = corpus_pipeline.mixed(spark, exact, "")
    assert mixed.columns == docs.columns and set(pairs(mixed)) <= set(pairs(exact))
    assert {r["doc_id"] for r in corpus_pipeline.packed(spark, mixed, "").collect()} == {r["doc_id"] for r in mixed.collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), "").count() == 0


def test_word_hashes():
    from tapewright.llm.common import split_words, word_hashes

    texts = ["a b", None, "", " b\x0b\x0cA\t\r\n", "é\u00a0x\x1cy " + "w" * 300, "w" * 300, "a", "b  a"]
    hashes, counts = word_hashes(pa.array(texts))
    plain = [(t or "").encode().split() for t in texts]
    assert counts.tolist() == [len(w) for w in plain]
    flat = [w for ws in plain for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat)) and all((hashes[i] == hashes[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))
    assert word_hashes(pa.array(texts), lower=True)[0][3] == hashes[0]
    words, at, sizes = split_words(pa.array(texts))
    assert [words[i] for i in at] == flat and sizes.tolist() == counts.tolist()
    assert len(word_hashes(pa.array([], pa.string()))[0]) == 0 and word_hashes(pa.array(texts[3:5]))[1].tolist() == [2, 2]
    assert word_hashes(pa.array(texts).slice(3, 2))[0].tolist() == word_hashes(pa.array(texts[3:5]))[0].tolist()


def joined(labels, pairs):
    """The partition of labels that the pairs make, as the smallest label of each."""
    into = {x: x for x in labels}
    for a, b in pairs:
        a, b = into[a], into[b]
        into = {k: min(a, b) if v in (a, b) else v for k, v in into.items()}
    return into


def test_forests_join_what_all_pairs_join():
    """Blocks of rows that meet, against a plain double loop; a forest never holds more pairs than components."""
    rng = np.random.default_rng(7)
    p = near_dedup.Params()
    for total, within in [(1, True), (2, True), (40, False), (90, True), (300, True), (300, False)]:
        base = rng.integers(0, 256, (6, p.symbols), dtype=np.uint8)
        sig = base[rng.integers(0, 6, total)]
        for row in sig:
            row[rng.integers(0, p.symbols, rng.integers(5, 60))] = rng.integers(0, 256)
        words = [np.unique(rng.integers(0, 1 << 40, 60, dtype=np.uint64)) for _ in range(6)]
        sets = []
        for _ in range(total):
            own = words[rng.integers(0, 6)].copy()
            own[: rng.integers(0, 12)] = rng.integers(0, 1 << 40)
            sets.append(np.unique(own))
        c, n, side = rng.integers(0, 30, total), rng.integers(90, 130, total), rng.integers(0, 2, total)
        near, linked = [], []
        for i in range(total):
            for j in range(i):
                if (side[i] != side[j] or within and side[i] == 1) and c[i] != c[j]:
                    if 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j]) and (sig[i] != sig[j]).sum() <= p.most_unequal:
                        near.append((int(c[i]), int(c[j])))
                    if near_dedup.linked(sets[i], sets[j], 80):
                        linked.append((int(c[i]), int(c[j])))
        labels = sorted(set(c.tolist()))
        for got, want in ((near_dedup.near_forest(c, sig, n, side, within, p, chunk=50), near), (near_dedup.linked_forest(c, sets, side, within, p), linked)):
            assert joined(labels, got) == joined(labels, want) and len(got) < len(labels)


def test_components_both_ways(spark):
    from tapewright.llm.graph import components

    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(-50, 150, (120, 2))] + [(1_000 + i, 1_001 + i) for i in range(40)] + [(5_000, 5_000 + i) for i in range(60)]
    want = joined(sorted({x for e in edges for x in e}), edges)
    table = spark.createDataFrame(edges, "u long, v long")
    for most in (1_000_000, 0):
        got = {r["node"]: r["component"] for r in components(table, most_at_once=most).collect()}
        assert got == {k: v for k, v in want.items() if k != v}
    assert components(table.where("false")).count() == 0


def test_op5_repeated_ids(spark):
    """An id with several texts links them, and none of their links is lost."""
    rng = np.random.default_rng(5)
    text = {k: [f"{k}{x}" for x in rng.integers(0, 900, 150)] for k in "abcd"}
    copy = lambda k, j: " ".join([*text[k][:j], "other", *text[k][j + 1 :]])
    rows = [(5, copy("a", 1)), (5, copy("b", 1)), (5, copy("b", 1)), (7, copy("a", 2)), (8, copy("b", 3)), (9, copy("c", 3)), (3, copy("c", 9)), (3, copy("d", 9)), (11, copy("d", 1)), (12, "alone"), (None, copy("a", 1))]
    for p in (near_dedup.Params(), near_dedup.Params(broadcast_ids=0, broadcast_rows=0)):
        got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), p=p).collect()
        assert len(got) == len(rows)
        assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 5), (7, 5), (8, 5), (9, 3), (3, 3), (11, 3), (12, 12), (None, None)}
