import random
import re

from tidemark.llm.licenses import TEMPLATES, licence_report, licence_spans

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"mit": "under the mit license".split(), "apache-2": "apache license version 2".split(), "cc-by-nc": "cc by nc".split()}


def brute(docs):
    out = []
    for doc, text in docs:
        w = W.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
        places = [(k, label) for label, p in BASE.items() for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        out.append((doc, len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
                    ",".join(sorted({label for _, label in places}))))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:3])


def test_base_places_equal_brute_force(make, odd, clashing):
    rng = random.Random(8)
    parts = "under the mit license apache version 2 cc by nc of and".split()
    docs = [(k, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for k in range(60)]
    docs += [(100, "CC BY-NC CC-BY/NC cc by nc"), (101, "Under the\nMIT (License) under the mit license"), (101, "under the mit license"), (102, None), (103, ""),
             (None, "Apache License, Version 2.0"), (104, "éunder the mit license"), (105, "under the mit license" * 400)]
    for frame in (make(docs), clashing(make(docs))):
        got = sorted((tuple(r[:6]) for r in licence_report(frame).collect()), key=key)
        assert got == sorted(brute(docs), key=key)
    assert licence_report(odd).count() == odd.count()
    assert licence_report(make([])).collect() == []


def test_labels_of_its_own(make):
    mit = next(t.words for t in TEMPLATES if t.label == "mit" and not t.exact).split()
    changed = mit[:12] + ["extra"] + mit[12:20] + mit[21:]
    docs = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, " ".join(["before"] * 9 + mit + ["after"])),
            (3, " ".join(changed)), (4, " ".join(mit[:9])), (5, " ".join(reversed(mit))), (6, "gnu general public license")]
    rows = {r.doc_id: r for r in licence_report(make(docs)).collect()}
    assert {k: r.labels for k, r in rows.items()} == {1: "gpl-3", 2: "mit", 3: "mit", 4: "", 5: "", 6: ""}
    assert rows[2].score == 1.0 > rows[3].score > 0.6 and rows[4].score == 0.0
    assert all(r.base_labels == "" and r.n_base == 0 for r in rows.values())
    span = licence_spans(make(docs)).where("doc_id = 2 and label is not null").first()
    assert (span["first"], span["end"]) == (9, 9 + len(mit))
