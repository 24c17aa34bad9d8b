"""References in exam answers: golden texts. Texts, names and the references that must come out."""

import pytest

from statuta.operators import evals

KNOWN = [("fkjl", "lov/2002-06-21-34"), ("forbrukerkjøpsloven", "lov/2002-06-21-34"), ("straffeloven", "lov/2005-05-20-28"), ("avtaleloven", "lov/1918-05-31-4"), ("forretningshemmelighetsloven", "lov/2020-03-27-15"), ("skatteloven", "lov/1999-03-26-14"), ("lov om avtaler", "lov/1918-05-31-4")]
GOLDEN = {
    "Etter fkjl § 16 kan forbrukeren reklamere. Se også § 17.": [("lov/2002-06-21-34", "16"), ("lov/2002-06-21-34", "17")],
    "Jf. fkjl. § 16. Straffeloven § 20 kan også komme til anvendelse.": [("lov/2002-06-21-34", "16"), ("lov/2005-05-20-28", "20")],
    "Forretningshemmelighetsloven\n\n§ 2 gir grunnlag.": [("lov/2020-03-27-15", "2")],
    "Avtaleloven er utgangspunktet.\n\nEn mellomliggende setning uten lovhenvisning.\n\n§ 36 må vurderes.": [],
    "Se § 16 uten å nevne noen lov.": [],
    "Skatteloven (lov/1999-03-26-14) § 6-1 gir grunnlag.": [("lov/1999-03-26-14", "6-1")],
    "Se [forskriften](/objects/forskrift/2006-02-17-204) § 2.": [("forskrift/2006-02-17-204", "2")],
    "avtalen § 2 og loven § 3.": [],
    "Svalbard-skatteloven § 3": [("lov/1999-03-26-14", "3")],
    "xfkjl § 1, fkjlx § 2, fkjl.2 § 3": [],
    "Etter lov om avtaler § 36": [],  # names of several words are not looked for
    "§ 4 følger av straffeloven": [("lov/2005-05-20-28", "4")],
    "": [],
}


def test_golden_texts(spark):
    docs = spark.createDataFrame(list(enumerate(GOLDEN)), "doc_id long, content string")
    got = {k: [] for k in range(len(GOLDEN))}
    for r in sorted(evals.exam_refs(docs, spark.createDataFrame(KNOWN, "token string, key string")).collect(), key=lambda r: (r.doc_id, r.line_no, r.ref_no)):
        got[r.doc_id].append((r.act, r.token))
    assert got == dict(enumerate(GOLDEN.values()))


@pytest.mark.parametrize("short, name, absent", [("CFE-avtalen", "Lov om inspeksjoner i samsvar med Avtalen om konvensjonelle styrker i Europa (CFE-avtalen)", "avtalen"), ("Lova", "Konvensjonen [direktivet]", "direktivet")])
def test_generic_words_name_no_act(spark, short, name, absent):
    laws = spark.createDataFrame([("lov/1992-05-29-50", short, name)], "key string, short_title string, name string")
    tokens = {r.token for r in evals.abbreviations(laws).collect()}
    assert absent not in tokens and not tokens & set(evals.GENERIC)
