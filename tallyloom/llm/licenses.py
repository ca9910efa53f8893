"""License scan: which license notices stand in a text, by MinHash windows and exact containment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import containment

# Published license names and notices, as (template, license, text).
TEMPLATES = [
    ("mit-released", "MIT", "Released under the MIT License."),
    ("mit-licensed", "MIT", "Licensed under the MIT License."),
    ("mit-grant", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2-notice", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2-header", "Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl-3-notice", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2-notice", "GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-header", "GPL", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl-notice", "LGPL", "licensed under the GNU Lesser General Public License"),
    ("agpl-notice", "AGPL", "licensed under the GNU Affero General Public License"),
    ("mpl-2-notice", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd-clause", "BSD", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("cc-by-nc-4", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-sa-4", "CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("unlicense", "Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights", "proprietary", "All rights reserved. No part of this work may be reproduced"),
]


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "template string, license string, template_text string")


def scan(docs: DataFrame, notices: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, template, license, matched, n_shingles, containment): one row per document and notice found in it.

    A notice counts as found when at least 0.8 of its five-word shingles stand in the document.
    Nulls, short texts, repeated rows and empty tables: as ``containment.search`` says. A document
    without a notice gives no row. ``notices`` has the columns (template, license, template_text).
    """
    notices = templates(docs.sparkSession) if notices is None else notices
    found = containment.search(docs, key, text, notices, "template", "template_text")
    names = notices.select("template", "license").distinct()
    return found.withColumnRenamed("item_id", "template").join(names, "template").select(
        "doc_id", "template", "license", "matched", "n_shingles", "containment")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ROWS = ", ".join(f"({_quoted(t)}, {_quoted(name)}, {_quoted(text)})" for t, name, text in TEMPLATES)
SCAN_SQL = f"""
with notices(item_id, license, text) as (values {_ROWS}),
found as ({containment.SEARCH_SQL.format(docs="documents", items="notices")})
select doc_id, item_id as template, license, matched, n_shingles, containment from found join notices using (item_id)
"""
