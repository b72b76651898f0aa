"""Licence scan against SQL and all templates without size bounds."""

import random
import time

import duckdb
import pytest

from tillcast.llm import licence_scan as ls


def scan(text, spec=ls.LicenceSpec()):
    return ls.Scanner(spec).scan(text)


def brute(words, spec):
    """The most like template over all templates."""
    own = ls.bigrams(words)
    found = []
    for name, text in spec.templates:
        other = ls.bigrams(ls._words(text.encode().lower()))
        if own and 200 * len(own & other) >= spec.percent * (len(own) + len(other)):
            found.append((-2 * len(own & other) / (len(own) + len(other)), name))
    return min(found, default=None)


@pytest.mark.parametrize("name", ["MIT", "ISC", "GPL-3.0", "Apache-2.0"])
def test_every_wording_is_found_inside_a_text(name):
    for licence, text in ls.TEMPLATES:
        if licence == name:
            assert scan(f"First line of prose.\n  ** {text.upper()} **\nLast line.") == {name: 1.0}
            half = text.split()
            wrapped = " ".join(half[: len(half) // 2]) + "\n" + " ".join(half[len(half) // 2 :])
            assert name in scan(f"Prose here.\n\n{wrapped}\n\nMore prose here.")


def test_size_bounds_lose_no_template():
    spec = ls.LicenceSpec(percent=60)
    for _, text in ls.TEMPLATES:
        words = ls._words(text.encode().lower())
        for cut in range(0, len(words), 3):
            for tried in (words[cut:], words[: len(words) - cut], words + [b"more"] * cut):
                found: dict = {}
                ls.Scanner(spec).compare(tried, found)
                best = brute(tried, spec)
                assert found == ({} if best is None else {best[1]: -best[0]})


def test_version_decides():
    assert set(scan("This work is licensed under the GNU General Public License, version 2.")) == {"GPL-2.0"}
    assert set(scan("Licensed under CC BY-NC 4.0.")) == {"CC-BY-NC-4.0"}
    assert scan("all rights were reserved by the garden") == {}


def test_odd_rows_and_sql(spark):
    mit = ls.TEMPLATES[11][1]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "All rights reserved."), (4, "ALL RIGHTS, reserved"), (5, f"x\n\n{mit}\n\ny"), (None, "Released under the MIT License."), (6, "word " * 60_000 + "\nAll rights reserved."), (7, "one")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, dice int, licence string")
    got = sorted((tuple(r) for r in ls.licences(df).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    assert got == sorted(con.execute(ls.licences_sql()).fetchall(), key=str)
    assert [r[:2] for r in got] == [(4, "All-rights-reserved"), (5, "MIT"), (6, "All-rights-reserved"), (None, "MIT")]
    assert ls.licences(df.limit(0)).count() == 0 and ls.licences(df, ls.LicenceSpec(templates=())).count() == 0


def test_notices_in_mid_line_and_wrapped():
    assert scan("Copyright 2019 Foo Inc. All rights reserved.") == {"All-rights-reserved": 1.0}
    assert set(scan("This project is released under the MIT License, see the file LICENSE.")) == {"MIT"}
    assert scan("Copyright 2020 Foo. Licensed under the Apache License, Version 2.0.") == {"Apache-2.0": 1.0}
    prose = "some words of an invented text about a garden behind the house " * 20
    for licence, text in ls.TEMPLATES:
        words = text.split()
        half = len(words) // 2
        wrapped = f"{prose}\n{' '.join(words[:half])}\n{' '.join(words[half:])} {prose}\n{prose}"
        assert scan(f"{prose} {text} {prose}") == scan(wrapped) == {licence: 1.0}
    gpl = ls.TEMPLATES[5][1].split()
    assert scan(f"{prose} {' '.join([*gpl[:20], 'All rights reserved.', *gpl[20:]])} {prose}").keys() == {"GPL-2.0", "All-rights-reserved"}


def every_window(words, spec):
    """The best coefficient of each licence over all windows, without anchors and before better matches of others count."""
    found = {}
    for name, text in spec.templates:
        known = ls._words(text.encode().lower())
        other = ls.bigrams(known)
        most = (200 - spec.percent) * (len(known) - 1) // spec.percent
        for first in range(len(words) - 1):
            for last in range(first + 1, min(len(words), first + most + 1)):
                own = ls.bigrams(words[first : last + 1])
                if 200 * len(own & other) >= spec.percent * (len(own) + len(other)):
                    found[name] = max(found.get(name, 0.0), 2 * len(own & other) / (len(own) + len(other)))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_anchors_lose_no_window(seed):
    draw = random.Random(seed)
    for _ in range(12):
        licence, text = draw.choice(ls.TEMPLATES)
        words = ls._words(text.encode().lower())
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(words))
            words[at : at + draw.randrange(2)] = [b"x", b"the", b"license"][: draw.randrange(3)]
        words = [b"under", b"a"] * draw.randrange(4) + words + [b"the", b"license", b"reserved"] * draw.randrange(4)
        for percent in (85, 60):
            spec = ls.LicenceSpec(percent=percent, templates=((licence, text),))
            found: dict = {}
            ls.Scanner(spec).windows(words, found)
            assert found == every_window(words, spec)


def test_repeated_notices_cost_no_more_each():
    text = ls.TEMPLATES[11][1]
    seconds = []
    for n in (200, 1600):
        begin = time.process_time()
        assert scan(" ".join([text] * n)) == {"MIT": 1.0}
        seconds.append(time.process_time() - begin)
    assert seconds[1] < 24 * seconds[0]
