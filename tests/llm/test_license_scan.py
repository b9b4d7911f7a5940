"""Licence detection: names, licence files, and a plain TF-IDF version."""

import math
import re
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tablemill.llm import license_scan

FILLER = " ".join(f"word{i}" for i in range(300))


def scan(spark, rows, **options):
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    return {r.doc_id: r for r in license_scan.scan_licenses(files, **options).collect()}


def test_every_text_has_its_own_name(spark):
    texts = {name: whole[-1] for name, whole in license_scan.TEMPLATES.items() if len(whole[-1].split()) > 80}
    assert {"AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "MIT", "MIT-0", "GPL-1.0", "LGPL-2.0", "MPL-1.1"} <= set(texts)
    names = sorted(texts)
    rows = [(i, f"/{n}/LICENSE", "Copyright (c) 2021 A Person\n\n" + texts[n]) for i, n in enumerate(names)]
    rows += [(100 + i, f"/src/{i}.c", f"{FILLER}\n{texts[n]}\n{FILLER}\n") for i, n in enumerate(names)]
    found = scan(spark, rows)
    assert [(found[i].license, found[i].origin) for i in range(len(names))] == [(n, "file") for n in names]
    assert [found[100 + i].license for i in range(len(names))] == names
    # Of the long ones, the whole file is similar.
    assert {found[100 + names.index(n)].origin for n in ("BSD-2-Clause", "ISC", "MIT", "MIT-0", "0BSD")} == {"header"}


def test_a_notice_makes_no_licence_file(spark):
    notice = "This work is licensed under the GNU General Public License, version 3"
    rows = [
        (1, "/a/one.txt", notice), (2, "/a/two.txt", "code"),
        (3, "/b/LICENSE.md", notice), (4, "/b/two.txt", "code"),
        (5, "/c/COPYING", (license_scan.TEXTS / "ISC.txt").read_text()), (6, "/c/d/x", None),
        (7, "/licenses", notice), (8, "/d/x.c", license_scan.NOTICES["BSD"][0]),
    ]
    found = scan(spark, rows)
    assert {i: (r.license, r.origin) for i, r in found.items()} == {
        1: ("GPL-3.0", "header"), 2: (None, None), 3: ("GPL-3.0", "file"), 4: ("GPL-3.0", "inherited"),
        5: ("ISC", "file"), 6: ("ISC", "inherited"), 7: ("GPL-3.0", "header"), 8: ("BSD", "header"),
    }


def plain_terms(text):
    return [x for x in (t.strip(".") for t in re.split(r"[^\w.]+|_", (text or "").lower())) if x]


def plain_scan(files, templates, similar):
    """Id -> (licence, origin) of the files that have one of their own: every line, every
    run as long as a template from every start, and the whole file."""
    made = [(name, Counter(plain_terms(t)), len(plain_terms(t)) < license_scan.NOTICE) for name, ts in templates.items() for t in ts]
    vocabulary = {t for _, c, _ in made for t in c}
    n, has = len(files), Counter(t for _, _, text in files for t in set(plain_terms(text)) & vocabulary)

    def vector(counts):
        x = {t: k * (math.log((1 + n) / (1 + has[t])) + 1 if t in vocabulary else math.log((1 + n) / 2) + 1) for t, k in counts.items()}
        norm = math.sqrt(sum(w * w for w in x.values()))
        return {t: w / norm for t, w in x.items()}

    known = [(name, vector(c), sum(c.values()), notice) for name, c, notice in made]

    def near(words):
        x = vector(Counter(words))
        for name, y, _, notice in known:
            cosine = round(sum(w * y.get(t, 0.0) for t, w in x.items()), 6)
            if cosine >= similar:
                yield notice, name == license_scan.BARE, -cosine, name

    found = {}
    for ident, path, text in files:
        words = plain_terms(text)
        base = re.match("[a-z]*", path.rsplit("/", 1)[-1].lower())[0]
        whole = [x[1:] for x in near(words) if not x[0] or base in license_scan.FILE_NAMES] if words else []
        pieces = {tuple(plain_terms(x)) for x in (text or "").split("\n")}
        pieces |= {tuple(words[i : i + size]) for *_, size, _ in known for i in range(len(words))}
        headers = [x for p in pieces if p for x in near(p)]
        if whole:
            found[ident] = (min(whole)[-1], "file")
        elif headers:
            found[ident] = (min(headers)[-1], "header")
    return found


@pytest.mark.parametrize("similar", [0.8, 0.6])
def test_against_plain_tfidf(spark, similar):
    mit = (license_scan.TEXTS / "MIT.txt").read_text()
    isc = (license_scan.TEXTS / "ISC.txt").read_text()
    templates = {n: license_scan.NOTICES[n] for n in ("MIT", "GPL-3.0", "Apache-2.0", "CC-BY-4.0", "BSD", license_scan.BARE)}
    templates["MIT"] += (mit,)
    templates["ISC"] = (isc,)
    drawn = spark.read.parquet(f"{SMALL}/documents.parquet").where(F.length("text") < 1500).orderBy("doc_id")
    files = [(r.doc_id, f"/{r.doc_id}/x.txt", r.text) for r in drawn.collect()]
    middle = " ".join(FILLER.split()[:40])
    planted = [
        f"{middle} {mit} {middle}", f"{mit} {middle} {mit}", isc.replace("ANY", "any kind of"), isc[: len(isc) // 2],
        "All rights reserved. " + middle, "// Licensed under the Apache\n// License, Version 2.0, " + middle, "", None, mit + isc,
        "Released under the\nMIT\nLicense", "Licensed under CC BY 4.0",
    ]
    files += [(10_000 + i, f"/p{i}/" + ("LICENSE.txt" if i % 2 else "code.c"), t) for i, t in enumerate(planted)]
    found = scan(spark, files, templates=templates, similar=similar)
    own = {i: (r.license, r.origin) for i, r in found.items() if r.origin not in (None, "inherited")}
    assert own == plain_scan(files, templates, similar)
    assert len(own) > 8
