"""Licence tags with prose or code behind the expression."""

import pytest

from storeops.llm import licences as lic


@pytest.mark.parametrize(
    "behind, said, score",
    [
        (" MIT. Copyright 2020 Foo", "mit", 0.25), (" MIT */ var a=1", "mit", 0.25), ("MIT and more text follows", "mit and more", 1.0),
        (" (MIT OR GPL-2.0-only) AND Apache-2.0 see the file", "( mit or gpl-2.0-only ) and apache-2.0", 0.25),
        (" GPL-2.0+ or", None, 0.0), (" GPL-2.0+ or */", "gpl-2.0+", 0.75), (" MIT OR (GPL-2.0 x", "mit", 0.25), (" mit, or gpl-2.0", "mit", 0.25),
        (" MIT) x", "mit", 0.25), (" (MIT", None, 0.0), (" OR MIT", None, 0.0), (" */ MIT", None, 0.0), ("\nMIT", None, 0.0),
        (" MIT SPDX-License-Identifier: Apache-2.0", "mit", 0.25),
    ],
)
def test_the_longest_expression_counts(behind, said, score):
    text = f"/* é SPDX-License-Identifier:{behind}".encode()
    _, _, _, expressions, worst = lic.scan(text, lic.automaton(), lic.tag_automaton())
    assert [e for e, _ in expressions][:1] == ([said] if said else []) and worst == score


def test_tags_in_the_query(spark, docs_of, tmp_path):
    text = "x SPDX-License-Identifier: MIT. Copyright 2020 Foo spdx-license-identifier: GPL-3.0-only */ var a=1"
    docs_of(text).write.parquet(str(tmp_path / "documents.parquet"))
    row = lic.op10_licences(spark, str(tmp_path)).first()
    assert (row.labels, row.score) == ("gpl-3.0-only,mit", lic.STRONG)
