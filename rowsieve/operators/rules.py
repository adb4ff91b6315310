"""Row-level schema: every row is valid under all column rules, or goes to quarantine.

A schema is a plain list of rules. Each rule turns into boolean columns, so the
whole check is one projection over the scan: no shuffle, no state, any number of
rows. It works the same on a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.functions import column, int_value, masked_timestamp, pattern_found

IS_VALID = "_is_valid"
FAILED = "_failed"


@dataclass(frozen=True)
class IntRule:
    """Integer column; ``big=True`` for 64 bits."""

    name: str
    is_nullable: bool = True
    big: bool = False
    fractions: str = "reject"

    def tests(self) -> dict[str, Column]:
        return {"int": self.value().isNotNull()}

    def value(self) -> Column:
        return int_value(column(self.name), big=self.big, fractions=self.fractions)


@dataclass(frozen=True)
class StringRule:
    """String column, with an optional pattern that is searched for in the value."""

    name: str
    is_nullable: bool = True
    matches: str | None = None
    full_match: bool = False

    def tests(self) -> dict[str, Column]:
        if self.matches is None:
            return {}
        found = pattern_found(column(self.name), self.matches, full_match=self.full_match)
        return {"matches": found}

    def value(self) -> Column:
        return column(self.name)


@dataclass(frozen=True)
class TimestampRule:
    """Text column that a date mask can read."""

    name: str
    mask: str
    is_nullable: bool = True

    def tests(self) -> dict[str, Column]:
        return {"timestamp": self.value().isNotNull()}

    def value(self) -> Column:
        return masked_timestamp(column(self.name), self.mask)


Rule = IntRule | StringRule | TimestampRule


@dataclass(frozen=True)
class Split:
    """The two sides of a checked table."""

    valid: DataFrame
    invalid: DataFrame


@dataclass(frozen=True)
class RowSchema:
    """Ordered column rules. Columns without a rule pass through unchanged."""

    rules: tuple[Rule, ...] = ()

    def _with(self, rule: Rule) -> RowSchema:
        if any(rule.name == other.name for other in self.rules):
            raise ValueError(f"column {rule.name!r} already has a rule")
        return replace(self, rules=(*self.rules, rule))

    def int_column(self, name: str, *, is_nullable: bool = True, **options: object) -> RowSchema:
        return self._with(IntRule(name, is_nullable, **options))

    def string_column(
        self,
        name: str,
        *,
        is_nullable: bool = True,
        matches: str | None = None,
        full_match: bool = False,
    ) -> RowSchema:
        return self._with(StringRule(name, is_nullable, matches, full_match))

    def timestamp_column(self, name: str, *, mask: str, is_nullable: bool = True) -> RowSchema:
        return self._with(TimestampRule(name, mask, is_nullable))

    def tests(self) -> dict[str, Column]:
        """One never-null boolean per rule, keyed ``column:test``.

        A null passes every test but ``not_null``, which only columns that must not
        be null have.
        """
        found: dict[str, Column] = {}
        for rule in self.rules:
            is_null = column(rule.name).isNull()
            if not rule.is_nullable:
                found[f"{rule.name}:not_null"] = ~is_null
            for kind, test in rule.tests().items():
                found[f"{rule.name}:{kind}"] = is_null | test
        return found

    def is_valid(self) -> Column:
        """All tests at once, reading each column as rarely as they allow."""
        parts = []
        for rule in self.rules:
            col, tests = column(rule.name), list(rule.tests().values())
            if rule.is_nullable:
                parts += [col.isNull() | test for test in tests]
            elif tests:
                parts += [F.coalesce(test, F.lit(False)) for test in tests]
            else:
                parts.append(col.isNotNull())
        return reduce(lambda left, right: left & right, parts) if parts else F.lit(True)

    def failed(self) -> Column:
        """Keys of the failed tests; only rows that fail pay for building the list."""
        reasons = [F.when(~test, F.lit(key)) for key, test in self.tests().items()]
        none = F.array().cast("array<string>")
        if not reasons:
            return none
        return F.when(self.is_valid(), none).otherwise(F.array_compact(F.array(*reasons)))

    def _require_columns(self, df: DataFrame) -> None:
        absent = [rule.name for rule in self.rules if rule.name not in df.columns]
        if absent:
            raise ValueError(f"the table has no column {absent}")

    def flag(self, df: DataFrame) -> DataFrame:
        """The table with ``_is_valid`` and ``_failed``; the latter costs nothing if unused."""
        self._require_columns(df)
        taken = {IS_VALID, FAILED} & set(df.columns)
        if taken:
            raise ValueError(f"the table already has {sorted(taken)}")
        return df.withColumns({IS_VALID: self.is_valid(), FAILED: self.failed()})

    def typed(self, df: DataFrame) -> DataFrame:
        """Ruled columns cast to their rule's type, the others as they are, order kept."""
        values = {rule.name: rule.value() for rule in self.rules}
        names = [name for name in df.columns if name not in (IS_VALID, FAILED)]
        return df.select(*[values.get(name, column(name)).alias(name) for name in names])

    def untyped(self, df: DataFrame, *, reasons: bool = False) -> DataFrame:
        """Original values, with the failed tests as a last column if asked for."""
        names = [name for name in df.columns if name not in (IS_VALID, FAILED)]
        return df.select(*map(column, names), *([FAILED] if reasons else []))

    def split(self, df: DataFrame, *, reasons: bool = False) -> Split:
        """Valid rows typed, invalid rows as they came."""
        flagged = self.flag(df)
        return Split(
            valid=self.typed(flagged.where(IS_VALID)),
            invalid=self.untyped(flagged.where(~F.col(IS_VALID)), reasons=reasons),
        )

    def counts(self, df: DataFrame) -> DataFrame:
        """One row: ``num_valid_rows``, ``num_invalid_rows``."""
        self._require_columns(df)
        valid = F.count_if(self.is_valid())
        return df.agg(
            valid.alias("num_valid_rows"),
            (F.count(F.lit(1)) - valid).alias("num_invalid_rows"),
        )

    def failure_counts(self, df: DataFrame) -> DataFrame:
        """Rows rejected by each test, from one aggregate: ``test, num_failed``."""
        self._require_columns(df)
        tests = self.tests()
        totals = df.agg(*[F.count_if(~test).alias(key) for key, test in tests.items()])
        pairs = [
            F.struct(F.lit(key).alias("test"), F.col(f"`{key}`").alias("num_failed"))
            for key in tests
        ]
        return totals.select(F.inline(F.array(*pairs)))
