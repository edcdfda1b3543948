"""The lines above the limits leave the text."""

from __future__ import annotations

from collections import Counter

from quartermaster.llm import quality_rules


def test_lines_above_the_limits_are_removed_from_the_texts(make_docs, clashes):
    rows = [(i, f"own é {i}\n  Shared  LINE\there \n\nshared line here\n{'x ' * 60}tail {i}", "en", "a") for i in range(7)]
    rows += [(100, "shared line here\nalone", "en", "b"), (101, None, "en", "a"), (102, "shared line HERE", "en", "a"),
             (None, "shared line here\n", "en", "a"), (103, "\n \n", "en", None), (3, rows[3][1], "en", "a")]
    out = [(r["row"]["doc_id"], r["kept_text"], r["n_removed_words"], r["n_words"])
           for r in quality_rules.quality_rules(make_docs(rows, clashes)).collect()]
    want = [(i, f"own é {i}\n\n{'x ' * 60}tail {i}", 6, 71) for i in (*range(7), 3)]
    want += [(100, "shared line here\nalone", 0, 4), (101, None, 0, 0), (102, "", 3, 3), (None, "", 3, 3), (103, "\n \n", 0, 0)]
    assert Counter(out) == Counter(want)


def test_remaining_words_and_removed_words_add_up(make_docs):
    lines = [" ".join(f"w{k}" for k in range(n)) for n in range(1, 30)]
    rows = [(i, "\n".join(lines[k] for k in range(29) if (i * k) % 5 == 1 or k == i), "en", f"h{i % 3}") for i in range(60)]
    rows += rows[:20]
    out = quality_rules.quality_rules(make_docs(rows)).collect()
    assert len(out) == 80 and any(r["n_removed_words"] for r in out)
    assert all(len(r["kept_text"].split()) + r["n_removed_words"] == r["n_words"] for r in out)
