"""What filters on a place in a genome ask for."""

from __future__ import annotations

from pyspark.sql.datasource import EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual


class Region:
    """Names and a range of places, from the filters that all rows must meet; columns: of the name, the start and the end (exclusive), counted from origin."""

    def __init__(self, name: str, start: str, end: str | None = None, origin: int = 0):
        self.columns, self.origin = (name, start, end), origin
        self.names: set[str] | None = None
        self.low, self.high = 0, 1 << 62  # rows over [low, high)
        self.least, self.most = -(1 << 62), 1 << 62  # rows that start in [least, most]

    def add(self, f: Filter) -> None:
        path = getattr(f, "attribute", ())
        column = path[0] if len(path) == 1 else None
        name, start, end = self.columns
        if column == name and isinstance(f, (EqualTo, In)):
            found = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.names = found if self.names is None else self.names & found
        elif column == start and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.value is not None:
            at = int(f.value) - self.origin
            if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                self.least = max(self.least, at + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                self.most = min(self.most, at - isinstance(f, LessThan))
        elif end and column == end and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and f.value is not None:
            self.low = max(self.low, int(f.value) - 1 - self.origin + isinstance(f, GreaterThan))

    def bounded(self) -> bool:
        return self.names is not None or self.low > 0 or self.least > -(1 << 62) or self.most < 1 << 62

    def of(self, name: str, length: int) -> tuple[int, int]:
        """The range [low, high) of a reference whose rows are asked for, empty if none are."""
        if self.names is not None and name not in self.names:
            return 0, 0
        return max(self.low, self.least, 0), min(self.high, self.most + 1, length)

    def may_hold(self, name: str, start: int) -> bool:
        """Whether a row of that name and start can be asked for."""
        return (self.names is None or name in self.names) and self.least <= start <= self.most
