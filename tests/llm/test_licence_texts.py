"""Licence texts as they are found in files, against licences named by hand."""

from pathlib import Path

import pytest

from ledgerlens.llm import licences
from llm_helpers import make_docs

MIT, ISC = licences.KNOWN["MIT"], licences.KNOWN["ISC"]


def published(name):
    return (Path(licences.__file__).parent / "licence_texts" / f"{name}.txt").read_text()


def flat(text):
    return " ".join(text.split())


@pytest.fixture(scope="module")
def found(spark):
    bsd, apache = published("BSD-3-Clause"), published("Apache-2.0")
    cases = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Foo Bar\n\n" + MIT),
        ("MIT", "The MIT License (MIT)\n\nCopyright © 2014-2020 Foo, Inc. All rights reserved.\n\n" + MIT),
        ("MIT", "Copyright The Foo Authors\n\n" + MIT),
        ("MIT", "Copyright (c) 2020 A " + flat(MIT)),
        ("MIT", "MIT License Copyright (c) 2020 Foo Bar " + flat(MIT)),
        ("MIT", "Copyright (c) 2020 " + ", ".join(f"Holder Number {i}" for i in range(300)) + " " + flat(MIT)),
        ("BSD-3-Clause", "Copyright (c) 2020 " + "Foo and Bar, " * 90 + "Baz. All rights reserved. " + flat(bsd)),
        ("MIT", MIT.replace("AUTHORS OR\nCOPYRIGHT HOLDERS", "AUTHORS OR COPYRIGHT HOLDERS").replace("WHETHER IN AN", "WHETHER\nIN AN")),
        ("ISC", "ISC License\n\nCopyright 2019 Foo\n\n" + ISC),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Foo\nAll rights reserved.\n\n" + bsd),
        ("BSD-3-Clause", "Copyright (c) 2020, Foo. All rights reserved. " + flat(bsd)),
        ("BSD-2-Clause", "# Copyright 2020 Foo\n" + published("BSD-2-Clause")),
        ("Apache-2.0", apache),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Foo Bar")),
        ("Apache-2.0", apache[:apache.index("APPENDIX")]),
        ("GPL-3.0", flat(published("GPL-3.0"))),
        *[(n, published(n)) for n in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "CC0-1.0", "BSL-1.0", "Unlicense",
                                      "Zlib", "GFDL-1.3", "Artistic-1.0-Perl")],
        (None, "Copyright (c) 2020 A " + "some long prose without any licence " * 20),
        (None, MIT + "\nand one more condition"),
        (None, None),
        (None, "Copyright (c) 2020 Foo\nAll rights reserved."),
    ]
    docs = make_docs(spark, [(i, t) for i, (_, t) in enumerate(cases)])
    rows = {r.doc_id: r for r in licences.scan(docs, licences.known_digests(spark)).collect()}
    return [(wanted, text, rows[i]) for i, (wanted, text) in enumerate(cases)]


def test_published_licences_are_known(found):
    assert [(text or "")[:60] for wanted, text, row in found if row.licence != wanted] == []


def test_statements_do_not_take_the_rest_of_their_line(spark, found):
    empty = licences.scan(make_docs(spark, [(1, "")]), licences.known_digests(spark)).first().digest
    assert found[-1][2].digest == empty  # nothing but a statement
    assert found[-4][2].digest != empty
