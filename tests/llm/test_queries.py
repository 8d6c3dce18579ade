"""The registered queries on the smallest tables, against SQL or brute force."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import brute
from oracle_check import compare, connect
from quipu.llm.queries import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the test tables")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang, source from '{ROOT}/documents.parquet' order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(ROOT), ROOT, QUERIES[name], ORACLES[name]) == ""


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_simhash(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_simhash"](spark, ROOT).collect()}
    prints = [brute.fingerprint(t) for _, t, _, _ in docs]
    groups = brute.components(prints)
    assert len(got) == len(docs)
    for (doc, *_), fp, first in zip(docs, prints, groups):
        assert (got[doc].fingerprint, got[doc].component_id) == (f"{fp:016x}", docs[first][0])


def test_chat(spark):
    turns = defaultdict(list)
    for conv, *rest in duckdb.sql(f"select conv_id, turn, role from '{ROOT}/conversations.parquet' order by 1, 2").fetchall():
        turns[conv].append(rest)
    got = defaultdict(list)
    for r in QUERIES["op3_chat"](spark, ROOT).collect():
        got[r.conv_id].append(r)
    assert got.keys() == turns.keys()
    for conv, rows in got.items():
        rows.sort(key=lambda r: r.turn)
        assert [r.turn for r in rows] == [t for t, _ in turns[conv]]
        assert sum(r.cost for r in rows) == brute.chat_cost(tuple(role for _, role in turns[conv]))
        assert brute.LEGAL.fullmatch("".join(r.rendered for r in rows))


def test_secrets(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op4_secrets"](spark, ROOT).collect()}
    assert len(got) == len(docs)
    for doc, text, *_ in docs:
        base, r = brute.base_secrets(text), got[doc]
        kinds = Counter(s.split(":")[0] for s in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == brute.sha(",".join(base))
        assert r.spans == ",".join(brute.all_secrets(text))


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t, *_ in docs}
    assert brute.check_packing(QUERIES["op5_packing"](spark, ROOT).collect(), ids) < 0.05


def test_rollup(spark, docs):
    import base64

    import public_tokenizers
    import tiktoken

    want = defaultdict(lambda: [0, 0])
    for version in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        with open(public_tokenizers.path(f"{version}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        coder = tiktoken.Encoding(version, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        seen = set()
        for _, text, lang, source in docs:
            if text not in seen:
                seen.add(text)
                once = "\n".join(dict.fromkeys(text.split("\n")))
                want[source, lang, version][0] += 1
                want[source, lang, version][1] += len(coder.encode_ordinary(once))
    got = {(r.source, r.lang, r.version): [r.docs, r.tokens] for r in QUERIES["op6_token_rollup"](spark, ROOT).collect()}
    assert got == dict(want)


def test_language(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op8_langid"](spark, "/root/testdata/sf0.01").collect()}
    rows = duckdb.sql("select doc_id, text, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    right = Counter()
    for doc, text, lang in rows:
        r = got[doc]
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out:
            right[r.lang_pred == lang] += 1
    assert right[True] / sum(right.values()) > 0.95


def test_merkle(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op9_merkle"](spark, ROOT).collect()}
    texts = [t or "" for _, t, *_ in docs]
    nearer = 0
    for i, (doc, changed) in enumerate(zip([d for d, *_ in docs], brute.edited(texts))):
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint == r.edited_fingerprint) == (texts[i] == changed)
        nearer += r.near_edited > r.near_next
    assert nearer / len(docs) > 0.9
    prints = defaultdict(set)
    for doc, text, *_ in docs:
        prints[text].add(got[doc].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for p in prints.values()}) == len(prints)


def test_repeats(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_repeats"](spark, ROOT).collect()}
    assert got == dict(zip([d for d, *_ in docs], brute.repeats([t for _, t, *_ in docs])))
