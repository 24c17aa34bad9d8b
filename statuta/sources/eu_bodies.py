"""EU acts as fetched: choice of the part that holds the text, its body as Markdown, fields of the metadata page, both sources merged."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pages import Node, parse

# Marks of the three forms of a text, and classes of the journal's form by what is done with them.
FORMEX, JOURNAL, LEGACY = ("<ACT", "<ARTICLE"), ("eli-subdivision", "oj-ti-art"), "<TXT_TE>"
LEAST_BYTES, PROLOGUE = 1000, 500
DROPPED = ["oj-hd-date", "oj-hd-lg", "oj-hd-ti", "oj-hd-oj", "eli-main-title", "oj-ti-art", "oj-sti-art", "oj-signatory", "oj-final", "oj-note"]
LEAST_CELL, LEAST_ITEM = 10, 5
# Labels of the metadata page and the fields that they fill; lists hold every identifier of an act.
FIELDS = {
    "Date of document": "date_of_document", "Date of effect": "date_of_effect", "Form": "form", "Author": "author", "Responsible body": "responsible_dg", "Subject matter": "subject_matter",
    "Directory code": "directory_code", "Legal basis": "legal_basis", "Procedure number": "procedure_num", "Instruments cited": "cited_celex", "Modified by": "modified_by_celex",
}
LISTS = {"author": 0, "subject_matter": 0, "legal_basis": 0, "cited_celex": 1, "modified_by_celex": 1}
CELEX = re.compile(r"\b(3\d{4}[A-Z]\d+)\b")
TITLE, CONCEPT, JOURNAL_REF = re.compile(r'name="WT\.z_docTitle"\s+content="([^"]+)"'), re.compile(r"eurovoc\.europa\.eu/(\d+)"), re.compile(r"OJ [A-Z]+ \d+[^<\n]{3,40}")
SHORT_TITLE = 120


def body_format(body: Column) -> Column:
    """formex, oj, legacy or null: what a part of a publication holds."""
    head = F.substring(body, 1, PROLOGUE)
    has = lambda c, x: F.contains(c, F.lit(x))
    journal = (has(head, "<html") | has(head, "<?xml")) & (has(body, JOURNAL[0]) | has(body, JOURNAL[1]))
    found = F.when(has(head, FORMEX[0]) & has(body, FORMEX[1]), "formex").when(journal, "oj").when(has(body, LEGACY), "legacy")
    return F.when(F.octet_length(body) >= LEAST_BYTES, found)


def chosen(parts: DataFrame) -> DataFrame:
    """id, body, format of each act's best part (id, seq, body): the journal's form in English, else the first by number; an old form
    only where there is no other."""
    language = F.trim(F.regexp_extract("body", r'class="oj-hd-lg">([^<]{0,5})<', 1))
    rows = parts.withColumn("format", body_format(F.col("body"))).where("format is not null")
    rank = F.when((F.col("format") == "oj") & (language == "EN"), 0).when(F.col("format") != "legacy", 1).otherwise(2)
    best = rows.withColumn("__rn", F.row_number().over(Window.partitionBy("id").orderBy(rank, "seq"))).where("__rn = 1")
    return best.select("id", "body", "format")


def squeezed(node: Node) -> str:
    return " ".join("".join(_strings(node)).split())


def _strings(node: Node) -> Iterator[str]:
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            yield x
        else:
            todo.extend(reversed(x.children))


def _role(node: Node) -> str:
    """What is done with an element of the journal's form."""
    name, id_ = node.attributes.get("class", ""), node.attributes.get("id", "")
    division = node.tag == "div" and "eli-subdivision" in name
    if id_ == "pbl_1" or any(x in name for x in DROPPED[:5]) or division and id_.startswith("cit_"):
        return "drop"
    if division and id_.startswith(("art_", "rct_")):
        return id_[:3]
    if any(x in name for x in DROPPED[5:]):
        return "drop"
    if node.tag == "p" and "oj-normal" in name:
        return "text"
    return "cells" if node.tag == "table" and "oj-hd" not in name else "through"


def journal_body(html: str) -> str:
    out: list[str] = []
    todo: list[Node] = [parse(html)]
    while todo:
        node = todo.pop()
        role = _role(node)
        if role == "art":
            last = {"oj-ti-art": "", "oj-sti-art": ""}
            for n in node.walk():
                mark = next((x for x in last if x in n.attributes.get("class", "")), None)
                if mark:
                    last[mark] = "".join(_strings(n)).strip()
            head = last["oj-ti-art"] + (f" — {last['oj-sti-art']}" if last["oj-sti-art"] else "")
            out += [f"## {head}"] if head else []
        elif role == "rct" and (t := squeezed(node)):
            out.append(f"({node.attributes['id'][4:]}) {t}")
        elif role == "text" and (t := squeezed(node)):
            out.append(t)
        elif role == "cells":
            out += [t for n in node.walk() if n.tag == "td" and len((t := squeezed(n)).encode()) > LEAST_CELL]
        if role in ("art", "through"):
            todo += reversed([c for c in node.children if isinstance(c, Node)])
    return "\n\n".join(out).strip()


def legacy_body(html: str) -> str:
    """The text between the old form's marks: paragraphs, headings, line breaks."""
    begin = html.find(LEGACY) if LEGACY in html else html.find('<div id="TexteOnly">')
    if begin < 0:
        return ""
    ends = [e for e in (html.find("</TXT_TE>", begin), html.find("</div>", begin)) if e >= 0]
    out: list[str] = []
    todo: list[Node] = [parse(html[begin : (html.find("</TXT_TE>", begin) if "</TXT_TE>" in html[begin:] else ends[0]) if ends else len(html)])]
    while todo:
        node = todo.pop()
        if node.tag == "br":
            out.append("\n")
        elif node.tag in ("p", "h1", "h2", "h3"):
            if t := squeezed(node):
                out.append(("" if node.tag == "p" else "## ") + t + "\n\n")
        else:
            todo += reversed([c for c in node.children if isinstance(c, Node)])
    return "".join(out).strip()


def formex_body(body: Column) -> Column:
    """Articles of the XML form as Markdown, by patterns alone."""
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    articles = F.regexp_extract_all(body, F.lit(r"(?s)<ARTICLE[^>]*>(.*?)</ARTICLE>"), F.lit(1))

    def one(a: Column) -> Column:
        number, title = bare(F.regexp_extract(a, r"(?s)<TI\.ART>(.*?)</TI\.ART>", 1)), bare(F.regexp_extract(a, r"(?s)<STI\.ART>(.*?)</STI\.ART>", 1))
        head = F.concat(F.lit("## "), F.when(number != "", number).otherwise("Article"), F.when(title != "", F.concat(F.lit(" — "), title)).otherwise(""))
        texts = F.filter(F.transform(F.regexp_extract_all(a, F.lit(r"(?s)<(?:ALINEA|P)>(.*?)</(?:ALINEA|P)>"), F.lit(1)), bare), lambda t: F.octet_length(t) > LEAST_ITEM)
        return F.array_join(F.concat(F.array(head), texts), "\n\n")

    return F.array_join(F.transform(articles, one), "\n\n")


def bodies(rows: DataFrame) -> DataFrame:
    """id, format, content of chosen(): each form by its own rules."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "format": f["format"], "content": [journal_body(b) if k == "oj" else legacy_body(b) for b, k in zip(f["body"], f["format"])]})

    walked = rows.where("format <> 'formex'").select("id", "format", "body").mapInPandas(run, "id string, format string, content string")
    return walked.union(rows.where("format = 'formex'").select("id", "format", formex_body(F.col("body"))))


def page_fields(html: str) -> dict:
    """The fields of a metadata page: label cells and the value cells after them; the first value of a label counts, and every act
    that lists of acts name."""
    out: dict = {f: [] if f in LISTS else "" for f in FIELDS.values()}
    label = ""
    for n in parse(html).walk():
        if n.tag in ("th", "dt"):
            label = "".join(_strings(n)).strip()
        elif n.tag in ("td", "dd"):
            value, open_ = squeezed(n), [f for text, f in FIELDS.items() if text in label and (LISTS.get(f) == 1 or not out[f])]
            if open_:
                field = open_[0]
                if LISTS.get(field) == 1:
                    out[field] += [c for c in dict.fromkeys(CELEX.findall(value)) if c not in out[field]]
                elif field in LISTS:
                    out[field] = [value]
                else:
                    out[field] = value.split(";")[0].strip() if field == "date_of_effect" and not value.startswith(";") else value
    title = TITLE.search(html)
    out["full_title"] = title[1] if title else ""
    at = out["full_title"].find("(")
    out["short_title"] = (out["full_title"][:at].strip() if at > 20 else out["full_title"])[:SHORT_TITLE]
    out["eurovoc_ids"] = list(dict.fromkeys(CONCEPT.findall(html)))
    journal = JOURNAL_REF.search(html)
    out["oj_reference"] = journal[0].strip() if journal else ""
    return out


PAGE = "id string, full_title string, short_title string, oj_reference string, eurovoc_ids array<string>, " + ", ".join(f"{f} {'array<string>' if f in LISTS else 'string'}" for f in FIELDS.values())


def metadata(rows: DataFrame) -> DataFrame:
    """The fields of metadata pages (id, html)."""
    names = [c.split()[0] for c in PAGE.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([{"id": r.id} | page_fields(r.html or "") for r in f.itertuples(index=False)], columns=names)

    return rows.select("id", "html").mapInPandas(run, PAGE)


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row for each id of either: the first source's, and the second's for acts that the first doesn't have."""
    return first.unionByName(second.join(first.select("id"), "id", "left_anti"), allowMissingColumns=True)
