"""Text clean-up from built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.vocabulary import PMS, Vocabulary


def title_case(text: Column) -> Column:
    """Capitalise every run of letters and digits, so `O'BRIEN PEREZ-LOPEZ` becomes `O'Brien Perez-Lopez`.

    Spark's own `initcap` starts words at white space only.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), run.substr(F.lit(2), F.length(run)))), "")


def country_of(national_id: Column, vocab: Vocabulary = PMS) -> Column:
    """Eight digits and nothing else is a domestic document."""
    return F.when(national_id.rlike(r"\A[0-9]{8}\z"), vocab.domestic).otherwise(vocab.foreign)


def mobile_number(phone: Column, prefix: str = "51") -> Column:
    """Nine digits get the country prefix, prefixed numbers stay, anything else is null."""
    return F.when(phone.rlike(r"\A[0-9]{9}\z"), F.concat(F.lit(prefix), phone)).when(
        phone.rlike(rf"\A{prefix}[0-9]{{9}}\z"), phone
    )


def given_names(full_name: Column) -> Column:
    """Surnames come first in the source, so the third and fourth words are the given names."""
    space = F.lit(" ")
    return F.concat(F.split_part(full_name, space, F.lit(3)), space, F.split_part(full_name, space, F.lit(4)))
