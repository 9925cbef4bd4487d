"""Operator 3: notices after other lead-ins, or none."""

from tonality.llm import licenses


def test_lead_ins_do_not_count(docs):
    names = {"the MIT License": "mit", "the Apache License, Version 2.0": "apache-2.0", "CC BY-NC 4.0": "cc-by,cc-by-nc-4.0",
             "the GNU General Public License, version 3": "gpl,gpl-3.0", "the GNU Lesser General Public License": "gpl,lgpl",
             "the Mozilla Public License, v. 2.0": "mpl-2.0", "the GNU General Public License, version 2": "gpl,gpl-2.0"}
    leads = ["", "Licensed under ", "distributed under ", "Released under ", "available under the terms of ", "This file is subject to "]
    rows = [(10 * i + k, f"some words {lead}{name} here", "en", "a") for i, name in enumerate(names) for k, lead in enumerate(leads)]
    rows += [(900, "MIT License", "en", "a"), (901, "licensed and released under license terms", "en", "a"), (902, "The MIT public license", "en", "a")]
    out = {r.doc_id: r.labels for r in licenses.scan(docs(rows)).collect()}
    for i, labels in enumerate(names.values()):
        assert [out[10 * i + k] for k in range(len(leads))] == [labels] * len(leads)
    assert out[900] == "mit" and out[901] == out[902] == ""
