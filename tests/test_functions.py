"""Column functions on literal cases."""

import hashlib
import json
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from packetmill import functions as f
from packetmill.functions.json import canonical_text, evidence_ids_of, holds_transcript
from packetmill.functions.urls import normal


@pytest.mark.parametrize(("text", "canonical"), [
    ('{"pear":[{"k":0,"j":[]}],"fig":{}}', '{"fig":{},"pear":[{"j":[],"k":0}]}'), ("[ ]", "[]"), ('[[2, "x"], null, false]', '[[2,"x"],null,false]'), ('"a/b"', '"a/b"'),
    ('{"b":1,"10":2,"9":3}', '{"9":3,"10":2,"b":1}'), ("2.0", "2"), ("-0", "0"), ("1e21", "1e+21"), ("1e-7", "1e-7"), ("12345678901234567890", "12345678901234567000"), ("0.000001", "0.000001"), ("123456.789", "123456.789"), ("5e-324", "5e-324"),
    ("1.7976931348623157e308", "1.7976931348623157e+308"), ('"\\u0007\\u00e9\\n"', '"\\u0007é\\n"'), ('{"a":1,"a":2}', '{"a":2}'), ("NaN", None), ("{", None), (None, None),
])
def test_canonical_text(text, canonical):
    assert canonical_text(text) == canonical


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=5), x, max_size=4), max_leaves=12))
def test_canonical_text_ignores_key_order_and_keeps_values(value):
    def shuffled(x):
        if isinstance(x, dict):
            items = list(x.items())
            random.shuffle(items)
            return {k: shuffled(v) for k, v in items}
        return [shuffled(v) for v in x] if isinstance(x, list) else x

    text = canonical_text(json.dumps(value))
    assert text == canonical_text(json.dumps(shuffled(value))) == canonical_text(text)
    same = lambda a, b: (isinstance(a, bool) == isinstance(b, bool) and (math.isclose(a, b, rel_tol=0) if isinstance(a, (int, float)) and isinstance(b, (int, float)) else type(a) is type(b) and (len(a) == len(b) and all(same(p, q) for p, q in zip(a, b, strict=True)) if isinstance(a, list) else a.keys() == b.keys() and all(same(a[k], b[k]) for k in a) if isinstance(a, dict) else a == b)))
    assert same(json.loads(text), value)


@pytest.mark.parametrize(("url", "official", "plain"), [
    ("HTTP://Shop.Garden.example/Seeds/?utm_term=x&UTM_content=y#rows", "http://shop.garden.example/Seeds", None), ("https://garden.example/plan/?bed=4&utm_id=9&row=b#end", "https://garden.example/plan?bed=4&row=b", None),
    ("https://a.com", "https://a.com/", "https://a.com/"), ("https://a.com/x//", "https://a.com/x/", None), ("HTTPS://A.com:443/p", "https://a.com/p", None), ("https://a.com/?q=a%20b", "https://a.com/?q=a%20b", None), ("https://a.com/?q=a%20b&UTM_x=1", "https://a.com/?q=a+b", None),
    ("https://a.com/?utm_x=1", "https://a.com/", "https://a.com/?utm_x=1"), ("https://a.com/b/../c/./d", "https://a.com/c/d", None), ("https://a.com/a b?c d", "https://a.com/a%20b?c%20d", None), ("https://a.com:8080/x/", "https://a.com:8080/x", None), ("not a url", None, None), ("mailto:x@y.z", "mailto:x@y.z", None), (None, None, None), ("https://a.com/x?", "https://a.com/x?", None),
    ("http://10.1/", "http://10.0.0.1/", None), ("http://0xC0.0250.0.1", "http://192.168.0.1/", None), ("http://3232235777./q", "http://192.168.1.1/q", None), ("http://1.2.3.4.5/", None, None), ("http://256.1.1.1/", None, None), ("http://a.09/", None, None), ("http://4.a/", "http://4.a/", None),
    ("http://stra\u00dfe.example/", "http://xn--strae-oqa.example/", None), ("http://b\u00fccher.example/", "http://xn--bcher-kva.example/", None), ("http://u ser:p=w@a.com/", "http://u%20ser:p%3Dw@a.com/", None), ("http://u:@a.com/", "http://u@a.com/", None), ("http://:@a.com/", "http://a.com/", None), ("http://a@b@c.com/", "http://a%40b@c.com/", None),
])
def test_urls(url, official, plain):
    assert normal(url, True) == official
    if plain:
        assert normal(url) == plain


def test_evidence_walk():
    text = '{"evidence_id":"a","n":[{"evidence_ids":["b","a",3]},{"evidence_ids":"x"}]}'
    assert evidence_ids_of(text) == ["a", "b"]
    assert evidence_ids_of('{"evidence_ids":[{"evidence_id":"x"}],"evidence_id":{"evidence_id":"y"},"deep":{"evidence_id":"z"}}') == ["z"]
    assert evidence_ids_of("{") == evidence_ids_of(None) == []
    assert holds_transcript('{"x":[{"transcript_text":"t"}]}') and not holds_transcript('{"transcript_text":null}')


def test_columns(spark):
    rows = spark.createDataFrame([(1, '{"b":1,"a":2}', "  a \n b  "), (2, None, ""), (3, "x", "y" * 300)], "id int, body string, text string")
    out = {r.id: r for r in rows.select("id", f.hash_canonical_json(F.col("body")).alias("h"), f.serialize_artifact(F.col("body")).alias("s"), f.preview_text(F.col("text")).alias("p"), f.sha256_hex(F.lit("abc")).alias("abc")).collect()}
    content = '{"a":2,"b":1}\n'
    assert out[1].h == out[1].s.sha256 == hashlib.sha256(content.encode()).hexdigest() and out[1].s.byte_count == len(content)
    assert out[1].abc == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert (out[1].p, out[2].p, len(out[3].p), out[3].p[-1]) == ("a b", None, 220, "…")
    assert out[2].h is None and out[3].h is None


@pytest.mark.parametrize(("url", "plain"), [
    ("http://[2001:DB8:0:0:0:0:0:1]/a/", "http://[2001:db8::1]/a"), ("http://[::FFFF:1.2.3.4]:80/", "http://[::ffff:102:304]/"), ("http://[1:0:0:2:0:0:0:3]/", "http://[1:0:0:2::3]/"), ("http://[0:0:0:0:0:0:0:0]/", "http://[::]/"), ("http://[1:0:3:4:5:6:7:8]:81/", "http://[1:0:3:4:5:6:7:8]:81/"),
    ("http://[1:2:3:4:5:6:0:0]/", "http://[1:2:3:4:5:6::]/"), ("http://[1::2::3]/", None), ("http://[fe80::1%25eth0]/", None), ("http://[12345::]/", None), ("http://[::1/", None), ("http://[1:0:0:4:5:0:0:8]/", "http://[1::4:5:0:0:8]/"),
    ("mailto:A@B.c?subject=x y#z", "mailto:A@B.c?subject=x%20y"), ("DATA:text/plain,é/", "data:text/plain,%C3%A9/"), ("tel:+1 2", "tel:+1 2"), ("foo://Host/a/../b/?q='#f", "foo://host/b?q='"), ("foo://Host", "foo://host"), ("foo://host:80/", "foo://host:80/"), ("foo:/a/./b/", "foo:/a/b"),
    ("foo://ho st/", None), ("foo:/..//p", "foo:/.//p"), ("git+ssh://u:p@H.x/~/y\\z", "git+ssh://u:p@h.x/~/y\\z"), ("file:///a", None), ("1a:b", None), ("foo:///x", "foo:///x"), ("https://a.com\\b\\", "https://a.com/b"), ("http:a.com", "http://a.com/"),
])
def test_hosts_and_other_schemes(url, plain):
    assert normal(url) == plain
    assert plain is None or normal(plain) == plain


def test_paths_and_urls(spark):
    rows = spark.createDataFrame([("v", "r")], "v string, r string")
    got = rows.select(f.packet_storage_prefix(F.col("v"), F.col("r")).alias("two"), f.packet_storage_prefix(F.col("v"), F.col("r"), "1.0.0").alias("one"), f.artifact_storage_path(F.lit("p/"), F.lit("organization_profile")).alias("a"), f.artifact_storage_path(F.lit("p"), F.lit("nothing")).alias("b")).first()
    assert tuple(got) == ("pre-research/v2/v/r", "pre-research/v1/v/r", "p/organization-profile/80-organization-profile.json", None)
    text = spark.createDataFrame([(1, "see https://A.com/x/. and (https://a.com/x?utm_a=1), http://b.org"), (2, None)], "id int, text string")
    assert {tuple(r) for r in f.extract_urls(text, "id", "text").collect()} == {(1, "https://a.com/x"), (1, "http://b.org/")}


def random_json(rng, depth=0):
    """A JSON text, or nearly one, by chance."""
    string = lambda: json.dumps("".join(rng.choice(["a", "b", "Z", "é", "\u2028", "\x7f", "\n", '"', "\\", "/", "\x01", "😀", "\ue000", "10", "9", 'x"y', "k:", "{", "[", ",", " "]) for _ in range(rng.randint(0, 4))), ensure_ascii=rng.random() < 0.3)
    blank = lambda: rng.choice(("", "", " ", "\n", "\t"))
    kind = rng.random()
    if depth > 3 or kind < 0.35:
        return rng.choice((string(), string(), "true", "null", *"0 -0 1 12345678901234567890 0.1 1.50 10.0 1e5 1E-7 0.0000001 0.000001 123456.789 -0.0 9007199254740993 1.0E10 0.1234567890123456 1e400 00 .5 NaN tru".split(), '"\\/"', '"\\ud800"'))
    if kind < 0.6:
        return "[" + blank() + ",".join(random_json(rng, depth + 1) + blank() for _ in range(rng.randint(0, 3))) + "]"
    return "{" + blank() + ",".join(string() + blank() + ":" + random_json(rng, depth + 1) for _ in range(rng.randint(0, 4))) + blank() + "}"


def test_canonical_json_on_the_jvm_equals_python(spark):
    """Whatever the guard lets through is the canonical text; long and deep texts, trailing characters and repeated keys included."""
    from packetmill.functions.json import canonical_json, written_as_parsed

    rng = random.Random(3)
    texts = [random_json(rng) + rng.choice(("", "", "", "", " ", "x", "}", " 1")) for _ in range(6000)]
    texts += ["", " ", "{", None, '"' + "a\\n" * 100_000 + '"', "[" * 2000 + "]" * 2000, "[1] [2]", '{"a":1,"a":2}', "\ufeff1", '{"b":1, "a":"x  y"}', "[1e5,-0.0,10.0]"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = rows.select("i", canonical_json(F.col("t")).alias("c"), written_as_parsed(F.col("t"))[0].alias("jvm")).collect()
    assert not [(texts[r.i], r.c) for r in out if r.c != canonical_text(texts[r.i])]
    assert sum(r.jvm for r in out) > 900 and not any(r.jvm for r in out if canonical_text(texts[r.i]) is None)


def test_structs_are_canonical_without_python(spark):
    """What Spark writes of a struct in key order is the canonical text, control characters and letters beyond ASCII included."""
    from packetmill.functions.json import canonical_json, canonical_struct

    texts = ["plain", "é😀/", 'quote " and \\ slash', "".join(map(chr, range(32))), "\\u001A as letters", "\\\\u001F", "\x7f\u2028", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "a int, b string")
    row = F.struct("a", "b", F.array(F.struct(F.lit(None).cast("string").alias("x"), F.col("b").alias("y"))).alias("c"))
    assert not [r for r in rows.select("b", canonical_struct(row).alias("s"), canonical_json(F.to_json(row, {"ignoreNullFields": "false"})).alias("p")).collect() if r.s != r.p]


def test_rewrite_idempotency(spark):
    body = '{"operations":[],"source":{"b":1,"a":2},"schema_version":"2.0.0","evidence_grades_used":["g"]%s}'
    key = hashlib.sha256(b'{"evidence_grades_used":["g"],"operations":[],"schema_version":"2.0.0","source":{"a":2,"b":1}}\n').hexdigest()
    rows = spark.createDataFrame([(1, body % ""), (2, body % f',"idempotency_key":"{key}"'), (3, body % ',"idempotency_key":"x"'), (4, "no json"), (5, None)], "id int, body string")
    got = {r.id: r.r for r in rows.select("id", f.rewrite_idempotency(F.col("body")).alias("r")).collect()}
    assert [(got[i].idempotency_key, got[i].rewritten) for i in (1, 2, 3)] == [(key, True), (key, False), (key, True)] and got[4].idempotency_key is got[5].idempotency_key is None


def test_equal_urls_of_a_batch_are_parsed_once():
    import pandas as pd

    from packetmill.functions import urls

    asked = []
    told = urls._once(pd.Series(["b", None, "a", "b", float("nan"), "bad", "bad"], index=range(7, 14)), lambda x: asked.append(x) or (None if x == "bad" else x.upper()))
    assert list(told) == ["B", None, "A", "B", None, None, None] and list(told.index) == list(range(7, 14)) and sorted(asked) == ["a", "b", "bad"]
    assert list(urls._once(pd.Series([None, None], dtype=object), str.upper)) == [None, None] and len(urls._once(pd.Series([], dtype=object), str.upper)) == 0
