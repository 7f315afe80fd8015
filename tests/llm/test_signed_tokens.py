"""Signed tokens beside full stops, dashes and other dotted words."""

from __future__ import annotations

import base64
import json

import pytest

from pulseframe.llm import secret_scan


def url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


TOKEN = ".".join([url64(json.dumps({"alg": "none"}).encode()), url64(b'{"sub":"x"}'), url64(bytes(range(100, 132)))])


@pytest.mark.parametrize("before", ["", " ", "...", "-", "--", "see-", "the-long-sentence.", "key_"])
@pytest.mark.parametrize("after", ["", ".", "...", ". Next", ".next.word", ")"])
def test_token_among_other_letters(before, after):
    found = [s[1:] for s in secret_scan.spans_of(before + TOKEN + after) if s[0] == "signed_token"]
    assert found == [(len(before), len(before) + len(TOKEN))]


def test_each_of_several_tokens():
    text = f"{TOKEN}.{TOKEN}, {TOKEN}."
    n = len(TOKEN)
    assert [s[1:] for s in secret_scan.spans_of(text) if s[0] == "signed_token"] == [(0, n), (n + 1, 2 * n + 1), (2 * n + 3, 3 * n + 3)]


def test_no_header_no_token():
    plain = url64(b'{"sub":"x"}')
    assert not [s for s in secret_scan.spans_of(f"{plain}.{plain}.{plain}. www.example-pages.org.") if s[0] == "signed_token"]
