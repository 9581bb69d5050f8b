import hashlib
import hmac
import os
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowtables.functions import crypto
from flowtables.operators import quarantine
from flowtables.operators.field_crypto import apply_plan

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def known_answers():
    """(iv, secret, {(field, plaintext): ciphertext}) from the fixture notes."""
    notes = open(os.path.join(ROOT, "FIXTURES.md"), encoding="utf-8").read()
    part = notes[notes.index("### 1.3"):notes.index("### 1.4")]
    iv = re.search(r"IV `([^`]+)`", part).group(1)
    secret = re.search(r"secret for encrypt/decrypt\s+`([^`]+)`", part).group(1)
    pairs = re.findall(r"\| (customer_no|card_no) \| `([^`]+)` \| `([^`]+)` \|", part)
    return iv, secret, pairs


def test_known_answers(spark):
    iv, secret, pairs = known_answers()
    assert len(pairs) == 4
    df = spark.createDataFrame([(p, c) for _, p, c in pairs], "plain string, sealed string")
    key = crypto.parse_iv(iv)
    out = df.select("plain", "sealed", crypto.encrypt(F.col("plain"), secret, key).alias("e"),
                    crypto.decrypt(F.col("sealed"), secret, key).alias("d")).collect()
    assert all(r.e == r.sealed and r.d == r.plain for r in out)


def test_key_derivation():
    # RFC 7914 section 11 gives PBKDF2-HMAC-SHA256 vectors; the library call is the same
    assert hashlib.pbkdf2_hmac("sha256", b"passwd", b"salt", 1, 64).hex().startswith("55ac046e56e3089fec1691c22544b605")
    assert crypto.derive_key("s") == hashlib.pbkdf2_hmac("sha256", b"s", b"s", 65536, 32)


def test_iv():
    assert crypto.parse_iv(None) == bytes(16)
    assert crypto.parse_iv(",".join(["-1"] * 16)) == b"\xff" * 16
    for bad in ("1,2", ",".join(["200"] * 16)):
        with pytest.raises(ValueError):
            crypto.parse_iv(bad)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40), min_size=1, max_size=10), st.text(min_size=1, max_size=80).filter(lambda s: s.isascii()))
def test_roundtrip_and_hash(spark, values, secret):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    iv = bytes(range(16))
    sealed = crypto.encrypt(F.col("v"), "secret", iv)
    out = df.select("v", crypto.decrypt(sealed, "secret", iv).alias("back"), crypto.keyed_hash(F.col("v"), secret).alias("h")).collect()
    for r in out:
        assert r.back == r.v
        assert r.h == hmac.new(secret.encode(), r.v.encode(), hashlib.sha256).hexdigest()


def test_plan_order_unknown_and_quarantine(spark):
    df = spark.createDataFrame([("a", 100), (None, 200)], "name string, amount int")
    plan = '[{"field":"amount","secret":"s","operation":"encrypt"},{"field":"amount","secret":"s","operation":"decrypt"},' \
           '{"field":"name","secret":"s","operation":"hash"},{"field":"amount","secret":"s","operation":"nothing"}]'
    good, bad = quarantine.split(apply_plan(df, plan))
    assert [tuple(r) for r in good.collect()] == [(hmac.new(b"s", b"a", hashlib.sha256).hexdigest(), "100")]
    # the rejected row is the second one, with the values it came with
    assert [tuple(r) for r in bad.collect()] == [(None, "200", "hash failed for field name")]
    twice = apply_plan(df, [{"field": "amount", "secret": "s", "operation": "encrypt"}, {"field": "name", "secret": "s", "operation": "hash"}])
    assert quarantine.split(twice)[1].first().amount == "200"
    with pytest.raises(ValueError):
        apply_plan(df, [{"field": "absent", "secret": "s", "operation": "hash"}])
    with pytest.raises(ValueError):
        apply_plan(df, [{"field": "name"}])


def test_bad_ciphertext_is_quarantined(spark):
    df = spark.createDataFrame([("not base64!",), ("AAAA",)], "v string")
    good, bad = quarantine.split(apply_plan(df, [{"field": "v", "secret": "s", "operation": "decrypt"}]))
    assert good.count() == 0 and {r.v for r in bad.collect()} == {"not base64!", "AAAA"}
