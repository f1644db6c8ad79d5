"""Secret scans against a plain search with each regex over every text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from odflow.llm import secrets

SCHEMA = "doc_id long, text string, kinds string, row string, key long"
KEY = "AKIA" + "A1B2C3D4E5F6G7H8"
HEX = "0123456789abcdef01234567"


def plain(text, rules=secrets.RULES):
    found = []
    for rank, rule in enumerate(rules):
        flags = re.ASCII
        for match in re.finditer(rule.pattern, text or "", flags):
            if len(match.group(rule.group)) >= rule.min_chars:
                found.append((match.start(), rank, match.end(), rule.kind))
    return sorted(found)


TEXTS = [
    None, "", " ", "password=hunter22", "PassWord : 'abc'", "token='abcdef' secret:\"ghijkl\"", "api_key=xyz123 APIKEY=uvw987",
    f"x{KEY}y", f"{KEY} {KEY}", "AKIASHORT", HEX, HEX + HEX, f"g{HEX}g {HEX[:23]}", f"token={HEX}", "é😀 secret=ß token=abcdefg",
    "password\n=\nabcdefg", "tok oke ken", "passwords", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "x" * 200_000 + f" {KEY}",
    "password=short password=longenough", "secret = = abcdefgh", "KEY apiK",
]


def test_spans_equal_a_plain_search(spark):
    rows = [(k, text, "k", "r", k) for k, text in enumerate(TEXTS)] + [(3, TEXTS[3], None, None, None), (None, TEXTS[3], None, None, 1)]
    found = secrets.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert [tuple(span) for span in row["secrets"]] == plain(row["text"]), row["text"]
    assert found[0].asDict().keys() == {"doc_id", "text", "kinds", "row", "key", "secrets"}


def test_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_redaction_replaces_spans_and_nothing_else(spark):
    docs = spark.createDataFrame([(k, text, 1) for k, text in enumerate(TEXTS)], "doc_id long, text string, n_chars long")
    for row in secrets.redact(docs).collect():
        text, out, at = TEXTS[row["doc_id"]], "", 0
        for start, _, end, _ in plain(text):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        if plain(text):
            assert row["text"] == out + text[at:] and row["n_chars"] == len(row["text"])
        else:
            assert row["text"] == text and row["n_chars"] == 1


def test_queries_of_the_rules():
    by_kind = {rule.kind: secrets.trigram_query(rule.pattern) for rule in secrets.RULES}
    assert by_kind["access"] == (frozenset({"aki", "kia"}),)
    assert by_kind["hex"] == secrets.ANYTHING
    assert frozenset({"tok", "oke", "ken"}) in by_kind["assign"]
    # An underscore makes other trigrams than none.
    assert any("pi_" in need for need in by_kind["assign"]) and any("pik" in need for need in by_kind["assign"])


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(["(?:abc|de?f)ghi+", "ab[cd]ef", "x(yz){2}w", "(foo|ba.)qux", "(?i)KeY[0-9]*END", "a?bcd|xyz"]), st.data())
def test_a_match_satisfies_the_query(pattern, data):
    text = data.draw(st.from_regex(pattern, fullmatch=True))
    if not text.isascii():
        return
    grams = {text.lower()[i:i + 3] for i in range(len(text) - 2)}
    assert any(need <= grams for need in secrets.trigram_query(pattern))
