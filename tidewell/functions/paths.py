"""Record paths (``data.items[0]``, ``$.data[*]``, ``$..items[?@.id > 3]['a b']``) over VARIANT columns.

A path is compiled to expressions over arrays of VARIANT, a level at a time. What is not understood in full is refused.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How deep ``..`` looks; deeper values raise an error instead of being passed over.
DESCENT = 12


@dataclass(frozen=True)
class Slice:
    """Array items from ``start`` to before ``stop``, as in Python."""

    start: int | None
    stop: int | None
    step: int = 1


@dataclass(frozen=True)
class Union:
    """Several keys, indexes or slices of one value, in the order given."""

    choices: tuple[str | int | Slice, ...]


@dataclass(frozen=True)
class Filter:
    """The items that pass a test: an expression tree of tuples."""

    test: tuple


@dataclass(frozen=True)
class Descend:
    """The value itself and everything below it."""


Step = str | int | None | Slice | Union | Filter | Descend  # None is the wildcard

_KEY = re.compile(r"[^.\[\]]+")
_QUOTED = re.compile(r"'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"")
_SLICE = re.compile(r"\s*(-?\d+)?\s*:\s*(-?\d+)?\s*(?::\s*(-?\d+)?\s*)?")
_INDEX = re.compile(r"\s*(-?\d+)\s*")
_NUMBER = re.compile(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?")
_COMPARE = re.compile(r"==|!=|<=|>=|<|>")


class _Reader:
    """A path being read, character by character."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def refuse(self) -> ValueError:
        return ValueError(f"cannot read the path {self.text!r} from character {self.at}: {self.text[self.at : self.at + 12]!r}")

    def take(self, literal: str) -> bool:
        if self.text.startswith(literal, self.at):
            self.at += len(literal)
            return True
        return False

    def match(self, pattern: re.Pattern) -> re.Match | None:
        found = pattern.match(self.text, self.at)
        if found:
            self.at = found.end()
        return found

    def space(self) -> None:
        while self.at < len(self.text) and self.text[self.at] in " \t":
            self.at += 1

    def quoted(self) -> str | None:
        found = self.match(_QUOTED)
        if not found:
            return None
        return re.sub(r"\\(.)", r"\1", found[1] if found[1] is not None else found[2])

    def steps(self, ends: str = "") -> list[Step]:
        """Steps until the end, or until a character of ``ends`` outside brackets."""
        out: list[Step] = []
        while self.at < len(self.text) and not (ends and self.text[self.at] in ends):
            if self.take(".."):
                out.append(Descend())
                if self.at < len(self.text) and self.text[self.at] == "[":
                    continue
                out.append(self.key(ends))
            elif self.take("["):
                out.append(self.bracket())
            elif self.take(".") or not out:
                out.append(self.key(ends))
            else:
                raise self.refuse()
        return out

    def key(self, ends: str) -> Step:
        found = self.match(re.compile(rf"[^.\[\]{re.escape(ends)}]+")) if ends else self.match(_KEY)
        if not found:
            raise self.refuse()
        return None if found[0] == "*" else found[0]

    def bracket(self) -> Step:
        if self.take("?"):
            test = self.any_of()
            self.space()
            if not self.take("]"):
                raise self.refuse()
            return Filter(test)
        choices: list[str | int | Slice | None] = []
        while True:
            self.space()
            choices.append(self.choice())
            self.space()
            if self.take("]"):
                break
            if not self.take(","):
                raise self.refuse()
        if len(choices) == 1:
            return choices[0]
        if None in choices:
            raise self.refuse()
        return Union(tuple(choices))

    def choice(self) -> str | int | Slice | None:
        if self.take("*"):
            return None
        name = self.quoted()
        if name is not None:
            return name
        cut = self.match(_SLICE)
        if cut:
            step = 1 if cut[3] is None else int(cut[3])
            if not step:
                raise self.refuse()
            return Slice(*[None if cut[k] is None else int(cut[k]) for k in (1, 2)], step)
        index = self.match(_INDEX)
        if not index:
            raise self.refuse()
        return int(index[1])

    def any_of(self) -> tuple:
        parts = [self.all_of()]
        while self.space() or self.take("||"):
            parts.append(self.all_of())
        return parts[0] if len(parts) == 1 else ("or", *parts)

    def all_of(self) -> tuple:
        parts = [self.one()]
        while self.space() or self.take("&&"):
            parts.append(self.one())
        return parts[0] if len(parts) == 1 else ("and", *parts)

    def one(self) -> tuple:
        self.space()
        if self.take("!") and not self.text.startswith("=", self.at):
            return ("not", self.one())
        if self.take("("):
            test = self.any_of()
            self.space()
            if not self.take(")"):
                raise self.refuse()
            return test
        left = self.operand()
        self.space()
        found = self.match(_COMPARE)
        if not found:
            if left[0] != "path":
                raise self.refuse()
            return ("exists", left)
        self.space()
        right = self.operand()
        if left[0] == "path":
            return (found[0], left, right)
        if right[0] != "path":
            raise self.refuse()
        turned = {"<": ">", ">": "<", "<=": ">=", ">=": "<="}
        return (turned.get(found[0], found[0]), right, left)

    def operand(self) -> tuple:
        if self.take("@"):
            steps = self.steps(" \t=!<>&|)]") if self.at < len(self.text) and self.text[self.at] in ".[" else []
            if not all(isinstance(s, (str, int)) for s in steps):
                raise self.refuse()
            return ("path", tuple(steps))
        text = self.quoted()
        if text is not None:
            return ("value", text)
        number = self.match(_NUMBER)
        if number:
            return ("value", json.loads(number[0]))
        for word, value in (("true", True), ("false", False), ("null", None)):
            if self.take(word):
                return ("value", value)
        raise self.refuse()


def parse_path(path: str) -> list[Step]:
    """Split a record path into its steps; ``ValueError`` where it is not understood.

    A wildcard beside a negative index ends the path: the array it stands on is the result.
    """
    body = path.removeprefix("$")
    steps = _Reader(body.removeprefix(".") if not body.startswith("..") else body).steps()
    if None in steps and any(isinstance(s, int) and s < 0 for s in steps):
        steps = steps[: steps.index(None)]
    return steps


def _get(value: Column, steps: list[str | int]) -> Column:
    """Walk keys and non-negative indexes in one ``variant_get``."""
    if not steps:
        return value
    text = "$"
    for step in steps:
        if isinstance(step, int):
            text += f"[{step}]"
        else:
            quote = '"' if "'" in step else "'"
            text += f"[{quote}{step}{quote}]"
    return F.try_variant_get(value, text, "variant")


def _as_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _as_map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _walk(value: Column, steps: list[str | int]) -> Column:
    run: list[str | int] = []
    for step in steps:
        if isinstance(step, int) and step < 0:
            # VARIANT paths reject negative indexes.
            value = F.try_element_at(_as_array(_get(value, run)), F.lit(step))
            run = []
        elif isinstance(step, str) and ("'" in step and '"' in step or "\\" in step):
            # They have no way to write such a key either.
            value = F.try_element_at(_as_map(_get(value, run)), F.lit(step))
            run = []
        else:
            run.append(step)
    return _get(value, run)


def path_variant(value: Column, path: str) -> Column:
    """The value at a path of keys and indexes, with its JSON type; SQL NULL when absent."""
    steps = parse_path(path)
    if not all(isinstance(s, (str, int)) for s in steps):
        raise ValueError(f"path may have more than one value: {path}")
    return _walk(value, steps)


def path_string(value: Column, path: str) -> Column:
    """The scalar at a path as text; NULL for absent values, nulls, arrays and objects."""
    found = path_variant(value, path)
    kind = F.schema_of_variant(found)
    return F.when(~kind.rlike("^(VOID|ARRAY|OBJECT)"), found.cast("string"))


def extract_elements(df: DataFrame, value: str, path: str | None, name: str) -> DataFrame:
    """Add the records at a path of the VARIANT column ``value``, as ``array<variant>``.

    A path of keys and indexes leads to one value: an array gives its elements, any other value gives itself, an absent value
    gives nothing. Any other path gives what it matches; ``..`` goes by levels, so nearer matches come first. Values that
    are used more than once get columns of their own, so that they are made once and not at each mention.
    """
    steps = parse_path(path) if path else []
    cut = next((i for i, s in enumerate(steps) if not isinstance(s, (str, int))), len(steps))
    walked = df.withColumn("_found", _walk(F.col(value), steps[:cut]))
    found = F.col("_found")
    if cut == len(steps):
        items = F.when(found.isNull(), _no_elements()).otherwise(F.coalesce(_as_array(found), F.array(found)))
        return walked.withColumn(name, items).drop("_found")
    # Below one value at first; a value that is absent matches nothing.
    walked = walked.withColumn("_at", F.when(found.isNull(), _no_elements()).otherwise(F.array(found)))
    rest = steps[cut:]
    while rest:
        if isinstance(rest[0], Descend):
            walked, rest = _descended(walked), rest[1:]
            continue
        plain = next((i for i, s in enumerate(rest) if not isinstance(s, (str, int))), len(rest))
        if plain:
            walked, rest = walked.withColumn("_at", _walk_all(F.col("_at"), rest[:plain])), rest[plain:]
        else:
            walked, rest = walked.withColumn("_at", F.flatten(F.transform("_at", _opener(rest[0])))), rest[1:]
    return walked.withColumn(name, F.col("_at")).drop("_found", "_at")


def _descended(df: DataFrame) -> DataFrame:
    """``_at`` with everything below its values, level by level."""
    levels = [f"_level{i}" for i in range(DESCENT + 1)]
    df = df.withColumn(levels[0], F.col("_at"))
    for above, below in zip(levels, levels[1:]):
        # Scalars have nothing below them, so most values end here.
        df = df.withColumn(below, F.flatten(F.transform(above, _open)))
    nested = F.exists(levels[-1], lambda v: F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)<."))
    deep = F.raise_error(F.lit(f"a path with .. meets values nested deeper than {DESCENT} levels")).cast("array<variant>")
    return df.withColumn("_at", F.when(nested, deep).otherwise(F.concat(*levels))).drop(*levels)


def _opener(step: Step):
    """What one value gives for a wildcard, slice, union or filter."""
    if step is None:
        return _open
    if isinstance(step, Slice):
        # The items get a name: the cut asks for their number at every item, and must not make them anew for it.
        return lambda v: F.flatten(F.transform(F.array(F.coalesce(_as_array(v), _no_elements())), lambda items: _cut(items, step)))
    if isinstance(step, Union):
        def chosen(v: Column) -> Column:
            parts = [_opener(c)(v) if isinstance(c, Slice) else F.array_compact(F.array(_walk(v, [c]))) for c in step.choices]
            return F.concat(*parts)

        return chosen
    if isinstance(step, Filter):
        return lambda v: F.filter(_open(v), lambda item: _passes(item, step.test))
    raise TypeError(step)


def _cut(items: Column, cut: Slice) -> Column:
    n = F.size(items)

    def place(k: int) -> Column:
        return F.lit(k) if k >= 0 else n + k

    if cut.step > 0:
        start = F.greatest(place(cut.start or 0), F.lit(0))
        stop = n if cut.stop is None else place(cut.stop)
        return F.filter(items, lambda _, i: (i >= start) & (i < stop) & ((i - start) % cut.step == 0))
    start = n - 1 if cut.start is None else F.least(place(cut.start), n - 1)
    stop = F.lit(-1) if cut.stop is None else F.greatest(place(cut.stop), F.lit(-1))
    return F.reverse(F.filter(items, lambda _, i: (i <= start) & (i > stop) & ((start - i) % -cut.step == 0)))


def _passes(item: Column, test: tuple) -> Column:
    kind = test[0]
    if kind in ("and", "or"):
        return reduce(lambda a, b: a & b if kind == "and" else a | b, [_passes(item, t) for t in test[1:]])
    if kind == "not":
        return ~_passes(item, test[1])
    value = _walk(item, list(test[1][1]))
    if kind == "exists":
        return value.isNotNull()
    if kind == "!=":
        return ~_passes(item, ("==", *test[1:]))
    if test[2][0] == "path":
        other = _walk(item, list(test[2][1]))
        if kind == "==":
            return F.coalesce(F.to_json(value) == F.to_json(other), value.isNull() & other.isNull())
        numbers = _order(kind, _comparable(value, 1), _comparable(other, 1))
        return F.coalesce(numbers, _order(kind, _comparable(value, ""), _comparable(other, "")), F.lit(False))
    literal = test[2][1]
    if literal is None:
        return F.coalesce(F.schema_of_variant(value) == "VOID", F.lit(False)) if kind in ("==", "<=", ">=") else F.lit(False)
    if isinstance(literal, bool) and kind not in ("==", "<=", ">="):
        return F.lit(False)
    op = "==" if isinstance(literal, bool) else kind
    return F.coalesce(_order(op, _comparable(value, literal), F.lit(float(literal) if isinstance(literal, int) and not isinstance(literal, bool) else literal)), F.lit(False))


def _comparable(value: Column, like: object) -> Column:
    """A VARIANT as a value of the type of ``like``, NULL if it is of another."""
    kind = F.schema_of_variant(value)
    if isinstance(like, bool):
        return F.when(kind == "BOOLEAN", value.cast("boolean"))
    if isinstance(like, (int, float)):
        return F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), value.cast("double"))
    return F.when(kind == "STRING", value.cast("string"))


def _order(op: str, a: Column, b: Column) -> Column:
    return {"==": a == b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]


def _walk_all(values: Column, steps: list[str | int]) -> Column:
    return F.filter(F.transform(values, lambda v: _walk(v, steps)), lambda v: v.isNotNull())


def _open(value: Column) -> Column:
    return F.coalesce(_as_array(value), F.map_values(_as_map(value)), _no_elements())


def _no_elements() -> Column:
    return F.array().cast("array<variant>")
