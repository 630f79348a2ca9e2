"""Every registered query of the subpackage on whole tables, against brute force where SQL cannot express it."""

import hashlib
import re
import struct
import unicodedata
import zlib

import pytest

import __spark_entry__ as entry
from tests.llm.test_llm import SF_DIR, brute_fingerprint, brute_roots

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]


def test_quality_of_all_documents(spark, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op1_quality")}
    assert found.keys() == texts.keys()
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_leaks_of_all_documents(spark, texts):
    letters = lambda t: "".join(c for c in t.lower() if unicodedata.category(c)[0] in "LMN")
    items = {r["item_id"]: letters(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    found = {r["doc_id"]: r for r in rows(spark, "op2_leaks")}
    assert found.keys() == texts.keys()
    verbatim = 0
    for i, text in texts.items():
        own = letters(text)
        whole = {k for k, item in items.items() if item in own}
        assert whole <= set(found[i]["items"]) and found[i]["contaminated"] == bool(found[i]["items"])
        assert not whole or found[i]["n_edits"] == 0
        verbatim += len(whole)
    assert verbatim > 0


def test_text_of_all_pages(spark):
    ids = [r["page_id"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    found = rows(spark, "op4_pages")
    assert sorted(r["page_id"] for r in found) == sorted(ids)
    assert all(r["n_chars"] == len(r["text"]) and "<" not in r["text"][:1] for r in found) and sum(r["n_chars"] > 0 for r in found) > 0.9 * len(found)


def test_base_spans_of_all_documents(spark):
    # the smallest table holds no secret
    larger = SF_DIR.replace("sf0.001", "sf0.01")
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()}
    patterns = [
        ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
        ("access", r"(AKIA[A-Z0-9]+)", 20),
        ("hex", r"([0-9a-f]+)", 24),
    ]
    found = {r["doc_id"]: r.asDict() for r in QUERIES["op6_secrets"](spark, larger).collect()}
    assert found.keys() == texts.keys()
    hits = 0
    for i, text in texts.items():
        spans = [(m.start(), k, m.end(), kind) for k, (kind, p, least) in enumerate(patterns) for m in re.finditer(p, text, re.ASCII) if len(m[1]) >= least]
        base = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
        assert found[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [found[i][f"n_{kind}"] for kind, *_ in patterns] == [sum(s[3] == kind for s in spans) for kind, *_ in patterns]
        assert set(base.split(",")) - {""} <= set(found[i]["spans"].split(","))
        hits += len(spans)
    assert hits > 0


def test_rules_of_all_pages(spark):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = {r["page_id"]: r for r in rows(spark, "op7_urls")}
    assert found.keys() == urls.keys()
    for i, url in urls.items():
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(fits, key=len, default=None)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == (rules[rule] if rule else "allow")


def test_components_of_all_documents(spark, texts):
    marks = {i: brute_fingerprint(t) for i, t in texts.items()}
    roots = brute_roots(sorted(set(marks.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    lowest = {}
    for i, m in marks.items():
        lowest[roots[m]] = min(lowest.get(roots[m], i), i)
    want = sorted((i, f"{m:016x}", lowest[roots[m]]) for i, m in marks.items())
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows(spark, "op8_simhash")) == want


def test_tokens_of_all_documents(spark, texts):
    from tokenizers import Tokenizer

    from gradlake.llm import bpe

    own = Tokenizer.from_file(bpe.default_tokenizer())
    found = {r["doc_id"]: r for r in rows(spark, "op10_bpe")}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = own.encode(text, add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False)
        assert found[i]["n_tokens"] == len(ids) and found[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_pipeline_run(spark, texts):
    from tokenizers import Tokenizer

    from gradlake.llm import bpe

    found = rows(spark, "pipeline")
    own = Tokenizer.from_file(bpe.default_tokenizer())
    assert 0.4 * len(texts) <= len(found) <= len(texts) and {r["doc_id"] for r in found} <= texts.keys()
    for r in found[:50]:
        ids = struct.unpack(f"<{r['n_tokens']}I", r["token_ids"])
        back = own.decode(list(ids), skip_special_tokens=False)
        # what is left of a text are whole lines of it, in order
        lines = iter(texts[r["doc_id"]].split("\n"))
        assert not back or all(line in lines for line in back.split("\n"))
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
