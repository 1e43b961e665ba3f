import re
import textwrap

import pytest

from gridlark.llm import license_scan
from gridlark.llm.common import words_of
from tests.llm.helpers import ODD, collected, docs

CODE = "\n".join(f"def function{i}(argument{i}): return value{i} of the thing" for i in range(300))


def bigrams(text):
    w = words_of(text.encode())
    return list(zip(w, w[1:], strict=False))


def runs(own, other):
    """Start and end of the runs of greatest sum, by trying all: over all hits, over first and over last occurrences."""
    hits = [i for i, p in enumerate(own) if p in other]
    first, last = {}, {}
    for i in hits:
        first.setdefault(own[i], i)
        last[own[i]] = i
    for some in (hits, sorted(first.values()), sorted(last.values())):
        yield max((2000 * (b - a + 1) - 800 * (some[b] - some[a] + 1), -some[a], -some[b]) for a in range(len(some)) for b in range(a, len(some)))[1:]


def brute(text, templates):
    """No bounds, no pruning: every passage against every template, and every run's sum for the best of them."""
    text = text or ""
    clean = re.sub(r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ", "".join(c.lower() if c.isascii() else c for c in text))
    passages = clean.split("\n") + (re.split(r"\n *\n", clean) if re.search(r"\n *\n", clean) else []) + ([clean] if "\n" in clean else [])
    best, n = None, 0

    def better(name, own, other):
        nonlocal best
        c = len(own & other)
        dice = 2 * c / (len(own) + len(other)) if other else 0
        if dice >= license_scan.THRESHOLD and (best is None or (c, dice) > best[2:] or (c, dice) == best[2:] and name < best[0]):
            best = (name, dice, c, dice)
        return dice >= license_scan.THRESHOLD

    for p in passages:
        own, reached = set(bigrams(p)), False
        for name, body in sorted(templates.items()):
            reached |= better(name, own, set(bigrams(body)))
        n += reached
    own = bigrams(clean)
    for name, body in templates.items():
        other = set(bigrams(body))
        if len(other) >= license_scan.RUN_BIGRAMS and len(set(own) & other) >= license_scan.fewest_shared(len(other), license_scan.THRESHOLD):
            for a, b in runs(own, other):
                better(name, set(own[-a : -b + 1]), other)
    return (*(best[:2] if best else (None, None)), n)


def test_like_brute_force(spark):
    notices = license_scan.NOTICES
    rows = ODD[:7] + ODD[8:] + [(100 + i, f"some code\n{b}\nmore", "s") for i, b in enumerate(notices.values())] + [(200 + i, b.replace(" the ", "\nthe ").upper(), "s") for i, b in enumerate(notices.values())]
    rows += [(300 + i, "x\n\n" + " ".join(w for k, w in enumerate(b.split()) if k % 11 or not k) + "\n \nend", "s") for i, b in enumerate(notices.values())]
    rows += [(400 + i, f"first {b[: len(b) // 2]} of the {b} and {b[len(b) // 3 :]} the rest", "s") for i, b in enumerate(notices.values())]
    some = notices | {"MIT full text": license_scan.all_templates()["MIT full text"]}
    got = collected(license_scan.scan_licenses(docs(spark, rows), templates=some))
    assert len(got) == len(rows)
    want = {}
    for i, t, _ in rows:
        want.setdefault(str(i), []).append(brute(t, some))
    for g in got:
        assert (g["license"], g["dice"], g["n_passages"]) in want[str(g["doc_id"])], g
    assert {g["license"] for g in got if 100 <= (g["doc_id"] or 0) < 200} == set(notices)


def test_full_texts_wrapped_and_commented_amid_code(spark):
    every = {n: b for n, b in license_scan.all_templates().items() if n.endswith("full text")}
    assert {f"{n} full text" for n in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")} <= set(every)
    rows, want = [], []
    for name, body in every.items():
        narrow = "\n\n".join(textwrap.fill(p, 47) for p in body.split("\n\n"))
        starred = "/*\n" + "\n".join(f" * {x}" for x in narrow.split("\n")) + "\n */"
        for text in (body, f"{starred}\n{CODE}", f"{CODE}\n{narrow}\n{CODE}", f"Copyright 2020 Someone\n{body}\n{CODE}\n{body}", f"{CODE} {' '.join(body.split())} {CODE}".replace("\n", " ")):
            rows.append((len(rows), text, "s"))
            want.append(name)
    got = {g["doc_id"]: g for g in collected(license_scan.scan_licenses(docs(spark, rows)))}
    assert [got[i]["license"] for i in range(len(rows))] == want
    assert min(g["dice"] for g in got.values()) >= 0.95


def test_notices_over_several_paragraphs_beside_other_text(spark):
    apache = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
    mozilla = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
    starred = lambda t: "/*\n" + "\n".join(f" * {x}" for x in t.split("\n")) + "\n */\n"
    rows = [(1, starred("Copyright 2020 Someone\n\n" + apache) + CODE, "s"), (2, CODE + "\n" + apache + "\n" + CODE, "s"), (3, starred(mozilla) + CODE, "s"), (4, CODE, "s")]
    got = {g["doc_id"]: g for g in collected(license_scan.scan_licenses(docs(spark, rows)))}
    assert [got[i]["license"] for i in range(1, 5)] == ["Apache-2.0", "Apache-2.0", "MPL-2.0", None]
    assert [got[i]["dice"] for i in (1, 2, 3)] == [1.0, 1.0, 1.0]


def test_bounds_lose_nothing():
    for m in range(1, 200):
        low, high = license_scan.bounds(m, 0.8)
        for n in range(1, 400):
            assert (2 * min(m, n) / (m + n) >= 0.8 - 1e-12) == (low <= n <= high)


def test_every_match_has_a_word_of_the_cover():
    templates = [license_scan.template_bigrams(b) for b in license_scan.NOTICES.values()]
    words = license_scan.cover(templates, 0.8)
    for pairs in templates:
        without = [p for p in pairs if not set(p.split(" ")) & set(words)]
        assert len(without) < license_scan.fewest_shared(len(pairs), 0.8)


@pytest.mark.parametrize("rows", [[], ODD])
def test_empty_and_native(spark, rows):
    out = license_scan.scan_licenses(docs(spark, rows))
    assert out.count() == len(rows)
    assert {g["license"] for g in collected(license_scan.scan_licenses(docs(spark, rows), templates={}))} <= {None}
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
