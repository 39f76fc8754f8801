"""Registered queries without SQL, against brute force over the whole tables of sf0.001; those with SQL against DuckDB."""

import hashlib
import html
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from eventloom.llm import bpe, language_id, secret_scans
from eventloom.llm.queries import ORACLES, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(spark, table="documents", col="text", key="doc_id"):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key, col).collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in df.select(cols).collect()))) == sorted(map(repr, expected))


def test_op2(spark):
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in QUERIES["op2_html_extraction"](spark, SF).collect()}
    for i, h in texts(spark, "pages", "html", "page_id"):
        article = re.search(r"<article>(.*?)(</article>|\Z)", h or "", re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?(b|br)>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(x for x in blocks if x)
        assert got[i] == (text, len(text))


def test_op3(spark):
    docs = [(i, WORD.findall(t or "")) for i, t in texts(spark)]
    seen = Counter(tuple(w[k : k + 35]) for _, w in docs for k in range(len(w) - 34))
    expected = {}
    for i, w in docs:
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        expected[i] = (len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone).encode()))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in QUERIES["op3_substring_dedup"](spark, SF).collect()}
    assert got == expected and any(e[1] for e in expected.values())


def python_features(candidate, left, right, path):
    """The features of a finding, once more in Python."""
    value = re.sub(secret_scans.VALUE, "", candidate)
    left, right, n = left[-60:], right[:60], max(1, len(value))
    count = lambda p, s: len(re.findall(p, s))
    covered = len(value) - len(re.sub(secret_scans.DICTIONARY, "", value.lower()))
    hold = any(re.search(secret_scans.PLACEHOLDER, s) for s in (value, left[-24:], right[:16]))
    return [
        len(value), count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", value) / n, count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])", value) / n,
        count(secret_scans.PAIRS, value.lower()) / n, covered / n if value else 1.0, count("[0-9]", value) / n, count("[A-Z]", value) / n, count("[^A-Za-z0-9]", value) / n,
        len(set(value)) / n, bool(re.search("^[0-9a-fA-F-]+$", value)), bool(re.search(secret_scans.VALUE, candidate)), bool(re.search(secret_scans.PROVIDER, value)),
        hold, bool(re.search(secret_scans.DIGEST, left)), bool(re.search("://[^\\s:/@\"'<>]{1,40}:$", left)) and right.startswith("@"), bool(re.search(r"[/.?&%][A-Za-z0-9_.-]*$|(?i:(?:href|src|url|id|data:image)[^\s]*$)", left)), bool(re.search(secret_scans.TEST_PATH, path)),
    ]


def python_scan(forest, text, path):
    """(start, candidate, score) of every candidate."""
    spots = [(m.start(), m[0]) for m in regex.finditer(secret_scans.CANDIDATE, text)]
    ends = [0, *(s + len(c) for s, c in spots)]
    nexts = [*(s for s, _ in spots[1:]), len(text)]
    out = []
    for k, (start, c) in enumerate(spots):
        x = python_features(c, text[ends[k] : start], text[start + len(c) : nexts[k]], path)

        def value(tree, x=x):
            while not isinstance(tree, float):
                tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
            return tree

        out.append((start, c, round(sum(map(value, forest)) / len(forest), 6)))
    return out


def test_op6(spark):
    sf = SF.replace("0.001", "0.01")  # the smallest tables hold no secret
    forest = secret_scans.train(spark)
    expected = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        expected |= {(r["doc_id"], s, c, x >= 0.5) for s, c, x in python_scan(forest, r["text"] or "", r["source"])}
    got = {(r["doc_id"], r["start"], r["candidate"], r["is_secret"]) for r in QUERIES["op6_secret_scans"](spark, sf).collect()}
    assert got == expected and any(e[3] for e in expected)


def encoded(lib, text):
    e = lib.encode(text or "", add_special_tokens=False).ids
    return len(e), b"".join(i.to_bytes(4, "little") for i in e), lib.decode(e, skip_special_tokens=False)


def test_op7(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op7_bpe"](spark, SF).collect()}
    for i, t in texts(spark):
        n, ids, decoded = encoded(lib, t)
        assert got[i] == (n, sha(ids), sha(decoded.encode()))


def test_op9_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = QUERIES["op9_language_id"](spark, SF).join(docs, "doc_id").where("held_out and n_chars > 20").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_op9_against_a_plain_network(spark):
    """Every row once more: one-hot bytes, convolution written as products, and the held-out rule in Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = language_id.fit(docs)
    got = {r["doc_id"]: r for r in QUERIES["op9_language_id"](spark, SF).collect()}
    eye = np.eye(256)
    for i, t in texts(spark):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not t or not any(map(str.isalpha, t)):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        data = t.encode()
        total = np.zeros(len(net.labels))
        for at in range(0, len(data), language_id.WINDOW):
            part = data[at : at + language_id.WINDOW]
            hot = eye[np.frombuffer(part.ljust(language_id.WINDOW, b"\0"), dtype=np.uint8)]
            pooled = []
            for table, bias in zip(net.tables, net.biases, strict=True):
                w = len(table)
                z = sum(hot[j : language_id.WINDOW - w + 1 + j] @ table[j].astype(float) for j in range(w)) + bias
                pooled.append(np.maximum(z, 0).max(axis=0))
            logits = np.concatenate(pooled) @ net.dense.astype(float) + net.offset
            total += len(part) * np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        mean = total / len(data)
        assert got[i]["score"] == pytest.approx(mean.max(), abs=1e-4)
        assert got[i]["lang_pred"] == net.labels[int(mean.argmax())] or np.sort(mean)[-1] - np.sort(mean)[-2] < 1e-4


def components(docs):
    """doc id -> (set size, least id reachable), by an exact prefix join."""
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    count = Counter(x for s in sets.values() for x in s)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i in sorted(sets, key=lambda i: len(sets[i])):
        s = sorted(sets[i], key=lambda x: (count[x], x))
        prefix = s[: len(s) - math.ceil(0.75 * len(s)) + 1] if s else []
        for j in {j for x in prefix for j in index[x]}:
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in prefix:
            index[x].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_op10(spark):
    expected = components(texts(spark))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_minhash_dedup"](spark, SF).collect()}
    assert got == expected and any(c != i for i, (_, c) in expected.items())


def test_pipeline(spark):
    """run() against each stage's brute force, one after the other."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    rows = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["text"] and any(map(str.isalpha, r["text"]))}
    kept = {i for i, (_, c) in components([(i, r["text"]) for i, r in rows.items()]).items() if c == i}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for _, t in texts(spark, "benchmark", "text", "item_id"):
        w = word.findall((t or "").translate(LOWER))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    forest = secret_scans.train(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = {r["doc_id"]: r["__lang"] for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    expected = {}
    for i in kept:
        r, w = rows[i], word.findall(rows[i]["text"].translate(LOWER))
        if any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1)):
            continue
        text = r["text"]
        for start, c, x in reversed(python_scan(forest, text, r["source"])):
            if x >= 0.5:
                text = text[:start] + "[SECRET]" + text[start + len(c) :]
        expected[i] = (text, r["lang"] or told[i], r["source"], r["n_chars"] + len(text) - len(r["text"]), *encoded(lib, text))
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "decoded", "n_tokens"]
    got = {r["doc_id"]: (r["text"], r["lang"], r["source"], r["n_chars"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in out.collect()}
    assert got == expected and len(expected) < len(rows)


def test_corpus_package_is_not_imported_by_the_rest():
    root = os.path.dirname(os.path.abspath(bpe.__file__)).rsplit(os.sep, 1)[0]
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "llm" not in re.findall(r"(?m)^\s*(?:from|import)\s+.*?\b(llm)\b", f.read())


def test_queries_read_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, table in (("op1_url_filters", "pages"), ("op2_html_extraction", "pages"), ("op7_bpe", "documents"), ("op9_language_id", "documents")):
        assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert docs.select(F.count("*")).first()[0] >= 200
