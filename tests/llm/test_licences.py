import random
import time

from martline.llm import licences
from tests.llm.test_quality_licences import brute_licence


def test_short_templates_against_brute_force():
    """Short notices between other words of templates, whole and with one word changed."""
    rng = random.Random(5)
    index = licences.Index(licences.TEMPLATES)
    common = ["of", "the", "by", "as", "to", "in", "and", "or", "is", "this", "license", "software", "zzz"]
    for name in [n for n in index.names if len(index.ids[index.names.index(n)]) < licences.SHORT]:
        notice = licences._WORD.findall(licences.TEMPLATES[name])
        for i in range(60):
            changed = list(notice)
            if i % 2:
                changed[rng.randrange(len(notice))] = "qqq"
            text = " ".join([*rng.choices(common, k=rng.randrange(8)), *changed, *rng.choices(common, k=rng.randrange(8))])
            want, got = brute_licence(text, licences.TEMPLATES[name]), [m[3] for m in index.matches(text, 0.8) if m[0] == name]
            # of alignments with equal scores the brute force takes the one with a word more
            assert bool(got) == (want >= 0.8) and (not got or -0.01 < want - max(got) < 0.01 + 1 / len(notice)), (name, text)
    assert [m[0] for m in index.matches("work as by All rights reserved.", 0.8)] == ["all-rights-reserved"]


def test_repeated_notices_take_time_in_proportion():
    """Texts of one notice over and over: every copy is found, and ten times the text takes about ten times as long."""
    index = licences.Index(licences.TEMPLATES)
    for name, n in (("all-rights-reserved", 2000), ("mit", 60), ("bsd-2-clause", 40)):
        began = time.perf_counter()
        assert sum(m[0] == name for m in index.matches((licences.TEMPLATES[name] + ". ") * n, 0.8)) == n
        once = time.perf_counter() - began
        began = time.perf_counter()
        assert sum(m[0] == name for m in index.matches((licences.TEMPLATES[name] + ". ") * 10 * n, 0.8)) == 10 * n
        assert time.perf_counter() - began < 40 * max(once, 0.05)


def test_mixed_occurrences_side_by_side():
    """Whole and damaged copies next to one another, of templates that share passages."""
    rng = random.Random(8)
    index = licences.Index(licences.TEMPLATES)
    for name in ("mit-notice", "apache-2.0-notice", "apache-2.0-header", "bsd-2-clause", "gpl-header"):
        words = licences._WORD.findall(licences.TEMPLATES[name])
        for _ in range(6):
            copies = []
            for _ in range(4):
                w = list(words)
                for _ in range(len(w) // 12 if rng.random() < 0.5 else 0):
                    w[rng.randrange(len(w))] = "qqq"
                copies.append(w)
            text = " ".join(x for w in copies for x in (*w, *["zzz"] * rng.randrange(3)))
            got = [m for m in index.matches(text, 0.8) if m[0] == name]
            assert len(got) == sum(sum(x != "qqq" for x in w) / len(w) >= 0.8 for w in copies), (name, text)
            assert all(a[5] <= b[4] for a, b in zip(sorted(got, key=lambda m: m[4]), sorted(got, key=lambda m: m[4])[1:], strict=False))


def test_a_first_half_is_not_the_whole_licence():
    index = licences.Index(licences.TEMPLATES)
    half = {m[0]: m[3] for m in index.matches(licences.TEMPLATES["mit-grant"], 0.8)}
    assert half == {"mit-grant": 1.0}
    assert {"mit", "mit-grant"} <= {m[0] for m in index.matches(licences.TEMPLATES["mit"], 0.8)}
