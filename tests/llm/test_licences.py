"""Known families in their own and in other words, unknown licences, ordinary text."""

import pytest

from orderloom.llm.licences import TEMPLATES, UNKNOWN, licence_paragraphs, train


@pytest.fixture(scope="module")
def model(docs_of, text_of):
    plain = "the history of the town and of its people is told in the books of the library under the old roof"
    return train(docs_of([(i, f"{text_of(i, 30)}\n{plain}\n{text_of(i + 500, 20)}") for i in range(60)]))


def test_every_template_is_found(docs_of, model, text_of):
    docs = docs_of([(i, f"{text_of(i, 20)}\n{t}\n{text_of(i + 99, 20)}") for i, (_, t) in enumerate(TEMPLATES)])
    out = {(r.doc_id, r.paragraph): r for r in licence_paragraphs(docs, model).collect()}
    assert set(out) == {(i, 1) for i in range(len(TEMPLATES))}
    right = sum(out[i, 1].family == f for i, (f, _) in enumerate(TEMPLATES))
    assert right >= len(TEMPLATES) - 2


def test_held_out_wordings(docs_of, model):
    cases = [("this code is released under the MIT license", "MIT"), ("Files here are licensed under the Apache License, Version 2.0, unless stated.", "Apache-2.0"),
             ("The work is licensed under the GNU General Public License version 3", "GPL-3.0"), ("Text: licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"),
             ("licensed under the terms of an agreement with all rights reserved by the publisher", UNKNOWN)]
    out = {r.doc_id: r for r in licence_paragraphs(docs_of([(i, t) for i, (t, _) in enumerate(cases)]), model).collect()}
    assert [out[i].family for i in range(len(cases))] == [f for _, f in cases]


def test_odd_rows(docs_of, model, text_of):
    docs = docs_of([(None, None), (1, ""), (2, "\n\n"), (None, "x\nReleased under the MIT License."), (3, "Released under the MIT License.\n" * 2),
                    (3, "Released under the MIT License.\n" * 2), (4, text_of(1, 30_000) + "\nReleased under the MIT License."), (5, "license"), (6, "the of and to")
                    ]).selectExpr("*", "n_chars AS gram", "lang AS family", "n_chars AS paragraph", "n_chars AS row_key")
    out = sorted((str(r.doc_id), r.paragraph, r.family, r.confirmed) for r in licence_paragraphs(docs, model).collect())
    assert out == sorted([("None", 1, "MIT", True), ("3", 0, "MIT", True), ("3", 1, "MIT", True), ("4", 1, "MIT", True)])
    assert licence_paragraphs(docs_of([]), model).collect() == []


def test_trains_without_documents(docs_of):
    assert licence_paragraphs(docs_of([])).collect() == []


def test_no_python(docs_of, model):
    plan = licence_paragraphs(docs_of([(1, "Released under the MIT License.")]), model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_wrapped_notices(docs_of, model, text_of):
    mit = ("# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal\n"
           "# in the Software without restriction")
    gpl = (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
           " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.")
    docs = docs_of([(1, f"{text_of(1, 20)}\n{mit}\n\n{text_of(2, 20)}"), (2, f"{gpl}\n{text_of(3, 20)}")])
    out = licence_paragraphs(docs, model).collect()
    assert {(r.doc_id, r.family) for r in out} == {(1, "MIT"), (2, "GPL-3.0")}
    assert {(r.doc_id, r.paragraph) for r in out} >= {(1, 1), (1, 2), (2, 1), (2, 2)} and all(r.confirmed for r in out)


LGPL = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version {} of the License, or (at your option) any later version.")


def test_versions_and_families_that_are_not_listed(docs_of, model, text_of):
    cases = [(LGPL.format("2.1"), "LGPL-2.1"), (LGPL.format("3"), "LGPL-3.0"), (LGPL.format("2"), UNKNOWN),
             ("This work is licensed under the GNU General Public License, version 1.", UNKNOWN),
             ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "EPL-2.0"),
             ("This work is licensed under the European Union Public License, version 1.2.", UNKNOWN),
             ("Licensed under the Open Widgets Software License, Version 7.0.", UNKNOWN),
             ("This program is free software; you can redistribute it and/or modify it under the terms of the Someone Else Public License.", UNKNOWN),
             ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0")]
    docs = docs_of([(i, f"{text_of(i, 20)}\n\n{t}\n\n{text_of(i + 99, 20)}") for i, (t, _) in enumerate(cases)])
    out = {r.doc_id: r for r in licence_paragraphs(docs, model).collect()}
    assert {i: out[i].family if i in out else None for i in range(len(cases))} == {i: f for i, (_, f) in enumerate(cases)}
