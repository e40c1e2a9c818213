import re

from pyspark.sql import functions as F

from rivulet.functions import taxid as T
from rivulet.operators import documents as D


def py_digit(num: str, cnpj: bool) -> int:
    """From the right: weights 2, 3, 4, ...; for a CNPJ 2 again after 9."""
    total, w = 0, 2
    for ch in reversed(num):
        total += int(ch) * w
        w = 2 if cnpj and w == 9 else w + 1
    m = total % 11
    return 11 - m if m > 2 else 0


def py_valid(doc, cnpj=False):
    d = re.sub(r"[^0-9]", "", doc or "")
    size, base = (14, 12) if cnpj else (11, 9)
    if len(d) != size:
        return False
    d1 = py_digit(d[:base], cnpj)
    d2 = py_digit(d[:base] + d[base], cnpj)
    return int(d[base]) == d1 and int(d[base + 1]) == d2


def py_complete(base, cnpj=False):
    d1 = py_digit(base, cnpj)
    return base + str(d1) + str(py_digit(base + str(d1), cnpj))


def test_cpf_cases(spark):
    good = py_complete("123456789")
    masked = f"{good[:3]}.{good[3:6]}.{good[6:9]}-{good[9:]}"
    wrong_digit = good[:10] + str((int(good[10]) + 1) % 10)
    # a base whose first remainder is exactly 2: check digit 0 under the "> 2" rule
    rem2 = next(f"{i:09d}" for i in range(1000, 100000)
                if sum(int(c) * (10 - k) for k, c in enumerate(f"{i:09d}")) % 11 == 2)
    cases = [None, "", masked, good, good[:10], wrong_digit, "11111111111", py_complete(rem2), "abc"]
    df = spark.createDataFrame([(c,) for c in cases], "doc string")
    got = [r[0] for r in df.select(T.cpf_valid("doc")).collect()]
    assert got == [py_valid(c) for c in cases]
    assert py_complete(rem2)[9] == "0"
    assert got[2] and got[3] and not got[4] and not got[5]


def test_cnpj_cases(spark):
    good = py_complete("112223330001", cnpj=True)
    masked = f"{good[:2]}.{good[2:5]}.{good[5:8]}/{good[8:12]}-{good[12:]}"
    cases = [None, "", good, masked, good[:13], good[:13] + str((int(good[13]) + 1) % 10)]
    df = spark.createDataFrame([(c,) for c in cases], "doc string")
    got = [r[0] for r in df.select(T.cnpj_valid("doc")).collect()]
    assert got == [py_valid(c, cnpj=True) for c in cases]


def test_check_digits_match_brute_force(spark):
    bases = [f"{(i * 7919) % 10**9:09d}" for i in range(300)]
    df = spark.createDataFrame([(b,) for b in bases], "b string")
    df = D.with_check_digits(df, F.col("b"), "cpf", "cpf")
    got = dict(df.select("b", "cpf").collect())
    assert all(got[b] == py_complete(b) for b in bases)
    b12 = [f"{(i * 104729) % 10**8:08d}0001" for i in range(300)]
    df = spark.createDataFrame([(b,) for b in b12], "b string")
    df = D.with_check_digits(df, F.col("b"), "cnpj", "cnpj")
    got = dict(df.select("b", "cnpj").collect())
    assert all(got[b] == py_complete(b, cnpj=True) for b in b12)


def test_format(spark):
    df = spark.createDataFrame([("12345678909",), (None,), ("123.456.789-09",)], "d string")
    got = [tuple(r) for r in df.select(T.cpf_format("d", True), T.cpf_format("d", False)).collect()]
    assert got == [("123.456.789-09", "12345678909"), ("", ""), ("123.456.789-09", "12345678909")]
    df = spark.createDataFrame([("11222333000181",)], "d string")
    assert df.select(T.cnpj_format("d", True)).first()[0] == "11.222.333/0001-81"


def test_generated_documents_validate(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    g = D.generate_cpf(df, ["k"], seed=1)
    g = D.generate_cpf(g, ["k"], seed=2, state=7, out="cpf_st")
    g = D.generate_cnpj(g, ["k"], seed=3)
    rows = g.collect()
    for r in rows:
        assert py_valid(r.cpf) and len(set(r.cpf[:9])) > 1
        assert py_valid(r.cpf_st) and r.cpf_st[8] == "7"
        assert py_valid(r.cnpj, cnpj=True) and r.cnpj[8:12] == "0001"
    again = [r.cpf for r in D.generate_cpf(df, ["k"], seed=1).collect()]
    assert again == [r.cpf for r in rows]


def test_quality_report(spark):
    good = py_complete("987654321")
    rows = [("a", good), ("a", good[:10]), ("a", good[:10] + str((int(good[10]) + 1) % 10)), ("b", None)]
    df = spark.createDataFrame(rows, "g string, doc string")
    q = {r.g: r for r in D.document_quality(df, "doc", "g").collect()}
    assert (q["a"].n_docs, q["a"].n_valid, q["a"].n_wrong_length, q["a"].n_wrong_digit) == (3, 1, 1, 1)
    assert (q["b"].n_docs, q["b"].n_wrong_length) == (1, 1)
