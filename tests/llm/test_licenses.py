import random
import re

import pytest

from rivulet.llm import license_scan as S

from .cases import AWKWARD, docs, empty

GPL3 = S.NOTICES[1][0]


def brute(rows):
    out = []
    for i, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        at = [(k, label) for phrase, label in S.PHRASES for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        places = [k for k, _ in at]
        out.append((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    return sorted(out, key=repr)


ROWS = AWKWARD + [
    (20, "Released under the MIT License."), (21, "MIT license, mit  LICENSE; MIT-License"), (22, "Licensed under CC BY-NC 4.0."),
    (23, "This work is licensed under the GNU General Public License, version 3."), (23, "other text with the same id, Apache License"),
    (24, f"/* {GPL3} */"), (25, "gnu general gnu general public license public"), (26, "ccby mit licenses apache  é license"),
    (None, "apache license"), (27, "cc by cc by cc cc by"), (28, "x " * 20_000 + "GNU General Public License " + "y " * 20_000),
    (20, "Released under the MIT License.")]


def test_phrases_equal_brute_force(spark):
    got = S.scan(docs(spark, ROWS)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_spans(text, notices, band=2, min_coverage=0.7, whole_below=14, min_votes=2):
    """Labels and score of the notices by the stated rule, one template and diagonal after the other."""
    w, accepted = words_of(text), []
    for t_text, label in notices:
        t = words_of(t_text)
        diagonals = {}
        for pos in range(len(w) - 1):
            for at in range(len(t) - 1):
                if w[pos:pos + 2] == t[at:at + 2]:
                    d = diagonals.setdefault(pos - at, {"at": set(), "first": False, "last": False})
                    d["at"].add(at)
                    d["first"] |= at == 1 and pos >= 2 and w[pos - 2] == t[0]
                    d["last"] |= at == len(t) - 3 and pos + 3 < len(w) and w[pos + 3] == t[-1]

        def runs(keys):
            out = []
            for k in sorted(keys):
                if out and k - out[-1][-1] <= band:
                    out[-1].append(k)
                else:
                    out.append([k])
            return out

        def measured(keys):
            votes = [diagonals[k] for k in keys]
            at = set().union(*(d["at"] for d in votes))
            first, last = any(d["first"] for d in votes), any(d["last"] for d in votes)
            words = {x for a in at for x in (a, a + 1)} | ({0} if first else set()) | ({len(t) - 1} if last else set())
            place = min(k + min([*d["at"], *([-1] if d["first"] else [])]) for k, d in zip(keys, votes))
            end = max(k + max([a + 2 for a in d["at"]] + ([len(t) + 1] if d["last"] else [])) for k, d in zip(keys, votes))
            share = len(words) / len(t)
            good = (sum(len(d["at"]) for d in votes) >= min_votes and end - place <= 1.5 * len(t)
                    and share >= (1.0 if len(t) < whole_below else min_coverage))
            return (place, end, share, label) if good else None

        for span in runs(diagonals):
            parts = [m for r in runs(k for k in span if len(diagonals[k]["at"]) >= min_votes) if (m := measured(r))]
            whole = measured(span)
            accepted += parts + ([whole] if whole and whole[2] > max([p[2] for p in parts], default=0) else [])
    accepted.sort(key=lambda m: (m[0], m[1]))
    heaps = []
    for m in accepted:
        if heaps and m[0] < max(x[1] for x in heaps[-1]):
            heaps[-1].append(m)
        else:
            heaps.append([m])
    best = [m for heap in heaps for m in heap if m[2] == max(x[2] for x in heap)]
    return sorted({m[3] for m in best}), max((m[2] for m in best), default=0.0)


def test_spans_equal_brute_force(spark):
    """Notices quoted, cut, with words put in, left out, doubled and mixed, among other words."""
    r = random.Random(3)
    rows = []
    for k in range(160):
        out = []
        for _ in range(r.randrange(1, 4)):
            w = words_of(r.choice(S.NOTICES)[0])
            for _ in range(r.randrange(5)):
                at = r.randrange(len(w))
                w = r.choice([w[:at] + ["zzz"] + w[at:], w[:at] + w[at + 1:], w[:at] + w[at:at + 1] + w[at:], w[:at] + w[at + 2:]]) or ["x"]
            out += ["other"] * r.randrange(3) + w
        rows.append((k, " ".join(out)))
    got = {x["doc_id"]: x for x in S.scan(docs(spark, rows, ""), phrases=()).collect()}
    hits = 0
    for k, text in rows:
        labels, score = brute_spans(text, S.NOTICES)
        assert (got[k]["labels"], round(got[k]["score"], 9)) == (",".join(labels), round(score, 9)), text
        hits += bool(labels)
    assert hits > 60


def test_more_licenses(spark):
    rows = [(k, f"some words {text} more words") for k, (text, _) in enumerate(S.NOTICES)]
    got = {x["doc_id"]: x["labels"].split(",") for x in S.scan(docs(spark, rows, "")).collect()}
    assert [S.NOTICES[k] for k in got if S.NOTICES[k][1] not in got[k]] == []
    assert "gpl-3.0" not in got[13] and "gpl-2.0" in got[13] and "lgpl-2.1" in got[15]


def test_notices_are_found_with_small_changes(spark):
    w = GPL3.split()
    edited = " ".join(w[:12] + ["really"] + w[12:25] + w[26:])
    twice = f"{GPL3}. And again: {edited}"
    rows = [(1, GPL3), (2, edited), (3, " ".join(w[:10])), (4, twice), (5, "Licensed under the Apache License, Version 1.0"),
            (6, "Licensed under the Apache License, Version 2.0"), (7, " ".join(reversed(w)))]
    got = {r["doc_id"]: r for r in S.scan(docs(spark, rows)).collect()}
    assert got[1]["labels"] == "gpl,gpl-3.0" and got[1]["score"] == 1.0
    assert "gpl-3.0" in got[2]["labels"].split(",") and 0.7 <= got[2]["score"] <= 1
    assert got[3]["labels"] == "" and got[3]["score"] == 0
    assert got[4]["n_base"] == 2 and "gpl-3.0" in got[4]["labels"]
    assert got[5]["labels"] == "apache" and got[6]["labels"] == "apache,apache-2.0"
    assert got[7]["labels"] == ""


def test_one_word_more_at_any_place_of_a_short_notice(spark):
    rows, label = [], {}
    for text, name in S.NOTICES:
        w = [x for x in re.split(S.BETWEEN_WORDS, text.lower()) if x]
        for k in range(1, len(w)) if len(w) < 14 else ():
            label[len(rows)] = name
            rows.append((len(rows), " ".join(["some", "text", *w[:k], "qqq", *w[k:], "other", "text"])))
    got = {r["doc_id"]: r for r in S.scan(docs(spark, rows)).collect()}
    assert len(rows) > 30 and [rows[k] for k in label if label[k] not in got[k]["labels"].split(",") or got[k]["score"] != 1] == []


def test_words_more_beside_single_votes(spark):
    rows = [(1, "This work is licensed under the GNU General Public License (GPL), version 3"), (2, "Released under the new MIT License"),
            (3, "Licensed under the Apache License, Version 1.0"), (4, "version 3. the GNU General Public License"),
            (5, "Released under the MIT License. mit license mit x license mit license"), (6, "mit license x mit license"),
            (7, "Released it all under the MIT License"), (8, "Released under the MIT good old License")]
    got = {r["doc_id"]: r["labels"] for r in S.scan(docs(spark, rows)).collect()}
    assert got == {1: "gpl,gpl-3.0", 2: "mit", 3: "apache", 4: "gpl", 5: "mit", 6: "mit", 7: "mit", 8: ""}
    score = {r["doc_id"]: r["score"] for r in S.scan(docs(spark, [(1, "Released under the new MIT X License")])).collect()}
    assert score == {1: 0.0}


def test_empty_table_and_short_templates(spark):
    assert S.scan(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        S.scan(docs(spark), phrases=(("mit", "mit"),))


def test_plan_has_no_python(spark):
    plan = S.scan(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan.replace("MapInArrow", "Arrow"))
