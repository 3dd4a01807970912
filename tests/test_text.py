"""Text functions by tables of cases."""

import pytest
from pyspark.sql import functions as F
from regatlas.functions import text as tx
from regatlas.profile import Profile


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "s string").select(fn(F.col("s"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [(None, ""), ("a &amp; b", "a & b"), (r"ACME\_CTRL \*x\*", "ACME_CTRL *x*"), ("a  b\n c", "a b c"), ("x�yz​", "xyz"), ("a\rb", "ab"), ("  ", "")],
)
def test_clean(spark, text, want):
    assert one(spark, text, tx.clean_text) == want


def test_noise_is_dropped_by_token(spark):
    assert one(spark, "keep Confidential-X this", tx.strip_noise) == "keep this"
    assert one(spark, "Document Classification A", tx.strip_noise) == "Document Classification A"


@pytest.mark.parametrize(
    ("word", "stem"),
    [("class", "clas"), ("classes", "classe"), ("string", "str"), ("series", "sery"), ("ties", "tie"), ("process", "proces"), ("dropped", "drop"), ("this", "this"), ("does", "does"), ("rx4s", "rx4s"), ("bus", "bus"), ("values", "valu"), ("value", "valu"), ("tree", "tree")],
)
def test_stem(spark, word, stem):
    assert one(spark, word, tx.light_stem) == stem


def test_tokens(spark):
    assert one(spark, "Reads RX_STAT4 of jobs, ACME_CTRL", tx.tokenize) == ["read", "rx_stat4", "rx", "stat4", "of", "job", "acme_ctrl", "acme", "ctrl"]
    assert one(spark, None, tx.tokenize) == []


@pytest.mark.parametrize(
    ("text", "want"),
    [("3.2 ACME_CTRL_STATUS", "ACME_CTRL_STATUS"), ("DescriptionRegistersRF(O..6)_RX_MIN", "RF(0..6)_RX_MIN"), ("plain sentence here", ""), ("see ACME_A, now", "ACME_A"), ("A_B", ""), (None, "")],
)
def test_register_token(spark, text, want):
    assert one(spark, text, tx.register_token) == want


def test_section_id(spark):
    rows = spark.createDataFrame([("ACME", "1.1 The Title!"), ("ACME", ""), ("ACME", "概述"), ("A", "x" * 200)], "m string, t string")
    got = [r[0] for r in rows.select(tx.section_id(F.col("m"), F.col("t"))).collect()]
    assert got[:3] == ["acme:1-1-the-title", "", "acme:"] and len(got[3]) == 120


def test_small_functions(spark):
    assert one(spark, "at 0x1F00 end", tx.first_hex) == "0x1F00" and one(spark, "none", tx.first_hex) == ""
    assert one(spark, " Over_flow  ERR ", tx.norm_field) == "over_flow_err"
    assert one(spark, "# Head\n## x \\_ y", tx.chunk_clean) == "Head x _ y"
    assert one(spark, "a/b/c.png", lambda c: tx.image_path(F.lit("M"), c)) == "images/M/c.png"
    assert one(spark, "", lambda c: tx.image_path(F.lit("M"), c)) == ""


def test_profile():
    p = Profile.from_dict({"register_name_pattern": "^R[0-9]+$", "enum_suffixes": ["_T"], "table_header_aliases": {"address": ["Offset"]}, "register_require_underscore": False})
    assert p.enum_suffixes == ("_T",) and p.aliases["address"] == ("address", "bar", "offset") and not p.require_underscore
    assert Profile().aliases["address"] == ("address", "bar")
    with pytest.raises(ValueError, match="nope"):
        Profile.from_dict({"table_header_aliases": {"nope": []}})
