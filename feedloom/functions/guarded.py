"""Expressions that mark the rows they stop on instead of stopping the query."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of parsed expressions, by the names that the SQL parser gives them. Fixed values.
ARITHMETIC = {"Add", "Subtract", "Multiply", "Divide", "Remainder"}
PLAIN = {
    "UnresolvedAttribute", "Literal", "Not", "IsNull", "IsNotNull", "EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual",
    "GreaterThan", "GreaterThanOrEqual", "In", "Like", "RLike",
}


class _Marks:
    """Rewrites a parsed expression: arithmetic and casts give NULL where they would stop, and a second expression says that they did."""

    def __init__(self, df: DataFrame):
        self.jvm = df.sparkSession._jvm
        self.parser = df.sparkSession._jsparkSession.sessionState().sqlParser()
        self.of = self.jvm.org.apache.spark.sql.catalyst.expressions
        self.attempt, self.stop = self.of.EvalMode.TRY(), self.of.EvalMode.ANSI()

    def tried(self, kind: str, values: list):
        """``try_add`` and so on, which the analyzer turns into the operation for the types at hand."""
        of_kind = getattr(self.of, kind)
        try:
            return of_kind(*values, self.attempt)
        except Py4JError:
            return of_kind(*values, self.of.NumericEvalContext.apply(self.attempt, True))

    def either(self, marks: list):
        found = [m for m in marks if m is not None]
        return reduce(self.of.Or, found) if found else None

    def both(self, a, b):
        return None if b is None else self.of.And(a, b)

    def rewritten(self, node):
        """(value, mark); the mark is None if nothing in it can stop. ``LookupError`` for a kind that is not known here."""
        kind = node.getClass().getSimpleName()
        children = [self.rewritten(node.children().apply(i)) for i in range(node.children().size())]
        values, marks = [v for v, _ in children], [m for _, m in children]
        if kind in ARITHMETIC or kind == "Cast":
            if not node.evalMode().equals(self.stop):
                return self.same(node, values), self.either(marks)
            made = self.of.Cast(values[0], node.dataType(), node.timeZoneId(), self.attempt) if kind == "Cast" else self.tried(kind, values)
            known = reduce(self.of.And, [self.of.IsNotNull(v) for v in values])
            return made, self.either([*marks, self.of.And(self.of.IsNull(made), known)])
        if kind in ("And", "Or"):
            # The right side counts only where the left one does not decide alone.
            decides = self.of.EqualNullSafe(values[0], self.parser.parseExpression("false" if kind == "And" else "true"))
            return self.same(node, values), self.either([marks[0], self.both(self.of.Not(decides), marks[1])])
        if kind in PLAIN:
            return self.same(node, values), self.either(marks)
        raise LookupError(kind)

    def same(self, node, children: list):
        return node.withNewChildren(self.jvm.PythonUtils.toSeq(children)) if children else node


def guarded(df: DataFrame, expression: str) -> Column:
    """The SQL expression as a struct ``(v)``: its value, or a NULL struct on rows where evaluating it raises an error.

    Comparisons, arithmetic and casts are rewritten to forms that raise nothing. Anything else is evaluated inside Catalyst's own
    guard, which catches every kind of error where it happens, at the price of an exception per row that stops. That guard stands in
    a branch, as a part that two expressions share would otherwise be worked out ahead of both; the branch's condition always holds.
    """
    marks = _Marks(df)
    column = marks.jvm.org.apache.spark.sql.classic.ExpressionUtils.column
    try:
        value, stops = marks.rewritten(marks.parser.parseExpression(expression))
    except LookupError:
        parsed = marks.parser.parseExpression(f"named_struct('v', ({expression}))")
        always = F.pmod(F.xxhash64(F.col(f"`{df.columns[0]}`")), F.lit(2).cast("long")) < 2
        return F.when(always, Column(column(marks.of.TryEval(parsed))))
    found = F.struct(Column(column(value)).alias("v"))
    return found if stops is None else F.when(~Column(column(stops)), found)
