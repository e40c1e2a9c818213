"""Tax-ID checks, formatting, synthesis and quality report over
columns of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import taxid as T
from rivulet.functions.text import col_of

# Fixed value ranges of the reference's generators: a CPF base is drawn from
# 0..999,999,998 (9 digits), or 0..99,999,998 followed by a state digit; a
# CNPJ base from 0..99,999,998 followed by the head-office suffix.
CPF_RANGE = 999_999_999
CPF_STATE_RANGE = 99_999_999
CNPJ_RANGE = 99_999_999


def _draw(seed: int, by: Sequence[str | Column], modulus: int) -> Column:
    """A repeatable draw in 0..modulus-1 per row: 60 bits of the MD5 of the
    seed and the row's identity."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(col_of(c).cast("string"), F.lit("")) for c in by])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(modulus))


def cpf_base(seed: int, by: Sequence[str | Column], state: int | Column | None = None) -> Column:
    """9-digit CPF base with no single repeated digit. A repeated base is
    raised by one (before the state digit), which always breaks the repeat."""
    if state is None:
        num = _draw(seed, by, CPF_RANGE)
        base = F.lpad(num.cast("string"), T.CPF_BASE_LEN, "0")
        bumped = F.lpad((num + 1).cast("string"), T.CPF_BASE_LEN, "0")
    else:
        st = state if isinstance(state, Column) else F.lit(state)
        digit = F.coalesce(st.between(0, 9), F.lit(False))  # any other state is ignored
        plain = cpf_base(seed, by)
        st = st.cast("string")
        num = _draw(seed, by, CPF_STATE_RANGE)
        base = F.lpad(F.concat(num.cast("string"), st), T.CPF_BASE_LEN, "0")
        bumped = F.lpad(F.concat((num + 1).cast("string"), st), T.CPF_BASE_LEN, "0")
    base = F.when(T.all_same_digit(base), bumped).otherwise(base)
    return base if state is None else F.when(digit, base).otherwise(plain)


def with_check_digits(df: DataFrame, base: Column, out: str, kind: str = "cpf") -> DataFrame:
    """``out`` = base + its two check digits, in staged projections (base,
    then first digit, then second), so each step reads plain columns."""
    base_len, _, weights_of = T._KINDS[kind]
    df = df.withColumn("_base", base)
    df = df.withColumn("_d1", T.check_digit(F.col("_base"), weights_of(base_len)).cast("string"))
    df = df.withColumn("_b1", F.concat(F.col("_base"), F.col("_d1")))
    df = df.withColumn(out, F.concat(F.col("_b1"), T.check_digit(F.col("_b1"), weights_of(base_len + 1)).cast("string")))
    return df.drop("_base", "_d1", "_b1")


def with_validity(df: DataFrame, doc: str, out: str, kind: str = "cpf", problem: bool = False) -> DataFrame:
    """O34/O35 over a frame: ``out`` = validity (or the problem text), with
    the digits staged once per row."""
    df = df.withColumn("_digits", T.digits_only(doc))
    d = F.col("_digits")
    return df.withColumn(out, T.problem_digits(d, kind) if problem else T.valid_digits(d, kind)).drop("_digits")


def generate_cpf(df: DataFrame, by: Sequence[str], seed: int = 0, state: int | Column | None = None,
                 out: str = "cpf") -> DataFrame:
    """One valid CPF per row, repeatable from (seed, ``by`` columns).
    A state outside 0..9 is ignored, as in the reference."""
    if isinstance(state, int) and not 0 <= state <= 9:
        state = None
    df = df.withColumn("_draw", cpf_base(seed, by, state))
    return with_check_digits(df, F.col("_draw"), out, "cpf").drop("_draw")


def generate_cnpj(df: DataFrame, by: Sequence[str], seed: int = 0, out: str = "cnpj") -> DataFrame:
    """One valid CNPJ per row (head office ``0001``)."""
    num = _draw(seed, by, CNPJ_RANGE)
    base = F.lpad(F.concat(num.cast("string"), F.lit(T.CNPJ_HEAD_OFFICE)), T.CNPJ_BASE_LEN, "0")
    return with_check_digits(df, base, out, "cnpj")


def document_quality(df: DataFrame, doc: str, by: str | Sequence[str], kind: str = "cpf") -> DataFrame:
    """Per group, documents checked and how many are valid, of wrong
    length, or with a wrong check digit (partial aggregation map-side)."""
    keys = [by] if isinstance(by, str) else list(by)
    checked = with_validity(df.select(*keys, doc), doc, "_p", kind, problem=True)
    return (checked.groupBy(*keys).agg(
                F.count(F.lit(1)).alias("n_docs"),
                F.count_if(F.col("_p") == "valid").alias("n_valid"),
                F.count_if(F.col("_p") == "wrong_length").alias("n_wrong_length"),
                F.count_if(F.col("_p") == "wrong_digit").alias("n_wrong_digit")))
