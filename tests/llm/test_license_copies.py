"""Copies of one notice close to each other, and short notices with an edited word."""

import time

import pytest

from fleetlens.llm import license_scan as L


def names(text):
    return [m[0] for m in L.LicenseIndex().matches(text)]


@pytest.mark.parametrize("gap", [0, 1, 3, 8, 20])
@pytest.mark.parametrize("notice, name", [("All rights reserved.", "All-rights-reserved"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0-notice"), ("Released under the MIT Licence.", "MIT-notice")])
def test_each_copy_is_a_row(notice, name, gap):
    for times in (2, 7):
        rows = [m for m in L.LicenseIndex().matches((notice + " filler" * gap + "\n") * times) if m[0] == name]
        assert len(rows) == times
        assert all(a[2] <= b[1] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("text", ["Released under the MIT Licence", "Published under the MIT License", "Released under a MIT License", "Released under the Mit style License", "Released beneath the MIT License"])
def test_short_notice_with_one_edited_word(text):
    assert "MIT-notice" in names("before it " + text + " and after")


def test_long_rows_of_copies_end():
    start = time.time()
    assert names("All rights reserved.\n" * 5000).count("All-rights-reserved") == 5000
    assert names("Released under the MIT Licence.\n" * 300).count("MIT-notice") == 300
    assert time.time() - start < 20
