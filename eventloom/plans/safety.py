"""What a free expression does on a bad row (N3): it must cost that row, not the job.

The expression is analysed once, on the driver, and every node of the analysed tree must be
known to yield a value, or NULL, for every row. Three tables say what is known:

* ``TOTAL``: nodes that never throw, whatever their arguments are;
* ``WITHIN``: nodes that never throw within a domain, with the test of it: a literal regular
  expression that compiles, an index other than 0, an evaluation mode that yields NULL;
* everything else is refused when the job is planned, with the form to write instead
  (``INSTEAD``) where there is one. Functions that Spark may add later are refused too, until listed.

An expression must also be deterministic: rows are read more than once, by retried tasks too.

Forms that yield NULL where another form would throw give an error flag: the input is there, the result
is not (``try_cast``, ``try_variant_get``, and what parses text: ``PARSERS``). A try form inside ``CASE``,
``IF`` or ``COALESCE`` is the author's own handling and gives none, nor does one that depends on a lambda's
variable.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from eventloom.plans.contract import ContractError

#: Nodes that yield a value or NULL for every row, by class name.
TOTAL = frozenset(
    # references and structure
    """Alias AttributeReference Literal TypedNullLiteral NamedLambdaVariable LambdaFunction GetStructField GetArrayStructFields
    CreateNamedStruct CreateArray With CommonExpressionDef CommonExpressionRef TypeOf"""
    # logic and choice
    """
    And Or Not EqualTo EqualNullSafe EqualNull LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual Between In InSet IsNull IsNotNull
    IsNaN Coalesce CaseWhen If NullIf Nvl Nvl2 NullIfZero ZeroIfNull NaNvl Greatest Least AtLeastNNonNulls"""
    # numbers
    """
    Acos Acosh Asin Asinh Atan Atan2 Atanh Cbrt Cos Cosh Cot Csc EulerNumber Exp Expm1 Hypot Log Log10 Log1p Log2 Logarithm Pi Pow Rint Sec
    Signum Sin Sinh Sqrt Tan Tanh ToDegrees ToRadians Factorial Bin Hex UnaryPositive BitwiseAnd BitwiseOr BitwiseXor BitwiseNot
    BitwiseCount ShiftLeft ShiftRight ShiftRightUnsigned TryAdd TrySubtract TryMultiply TryDivide TryMod"""
    # text
    """
    Ascii Chr BitLength OctetLength Length Upper Lower InitCap Reverse ConcatWs Contains StartsWith EndsWith StringInstr StringLocate
    StringTrim StringTrimBoth StringTrimLeft StringTrimRight Substring Left Right StringReplace StringTranslate SoundEx
    Levenshtein FindInSet Overlay Md5 Sha1 Sha2 Crc32 Murmur3Hash XxHash64 Base64 IsValidUTF8 MakeValidUTF8 TryValidateUTF8 UrlEncode
    TryUrlDecode TryParseUrl TryToBinary Quote Luhncheck Mask"""
    # JSON and variants
    """
    GetJsonObject LengthOfJsonArray JsonObjectKeys StructsToJson IsVariantNull SchemaOfVariant ToVariantObject"""
    # arrays, maps and lambdas
    """
    Size ArraySize ArrayContains ArrayDistinct ArrayExcept ArrayIntersect ArrayUnion ArrayJoin ArrayMax ArrayMin ArrayPosition ArrayRemove
    ArrayCompact ArrayAppend ArrayPrepend ArraysOverlap ArraysZip Flatten SortArray Get GetMapValue MapKeys MapValues MapEntries
    MapContainsKey MapFilter TransformValues MapZipWith ArrayTransform ArrayFilter ArrayExists ArrayForAll ArrayAggregate ZipWith"""
    # dates and times
    """
    Year Quarter Month DayOfMonth DayOfWeek WeekDay DayOfYear WeekOfYear Hour Minute Second SecondWithFraction Extract DateDiff DateAdd
    DateSub UnixDate UnixMicros UnixMillis UnixSeconds DateFromUnixDate MicrosToTimestamp DayName MonthName CurrentDate CurrentTimestamp
    Now LocalTimestamp CurrentTimeZone""".split()
)

#: What to write instead of a node that can throw.
INSTEAD = {
    "Divide": "try_divide", "IntegralDivide": "try_divide", "Remainder": "try_mod", "Pmod": "try_mod",
    "Add": "try_add", "Subtract": "try_subtract", "Multiply": "try_multiply", "UnaryMinus": "try_subtract(0, ...)", "Abs": "greatest(x, try_subtract(0, x))",
    "ElementAt": "try_element_at with an index other than 0, or get", "TryElementAt": "get", "GetArrayItem": "get",
    "Cast": "try_cast", "VariantGet": "try_variant_get", "ParseJson": "try_parse_json", "JsonToStructs": "from_json without options",
    "ParseToTimestamp": "try_to_timestamp", "ParseToDate": "try_to_date", "ParseUrl": "try_parse_url", "UrlDecode": "try_url_decode",
    "ToNumber": "try_to_number", "ToBinary": "try_to_binary", "UnBase64": "try_to_binary(x, 'base64')", "Unhex": "try_to_binary(x, 'hex')",
    "ValidateUTF8": "try_validate_utf8", "MakeDate": "try_to_date", "MakeTimestamp": "try_make_timestamp",
    "MillisToTimestamp": "timestamp_micros(try_multiply(x, 1000))", "SecondsToTimestamp": "timestamp_micros(try_multiply(x, 1000000))",
    "Elt": "get(array(...), i - 1)", "Like": "a literal pattern", "RLike": "a literal pattern without a repeated group",
}
HANDLED = ("CaseWhen", "If", "Coalesce", "Nvl", "Nvl2")
FRACTIONS = ("double", "float")
WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Try forms that parse text: NULL for a text that is there is an error of the row.
PARSERS = ("ParseToTimestamp", "ParseToDate", "ParseJson", "TryToNumber", "TryToBinary", "TryUrlDecode", "TryParseUrl", "TryValidateUTF8")
#: Longest text or array that a literal count may ask for.
LONGEST = 10_000
DATE_PATTERN = re.compile(r"(?:yyyy|MMM?|M|dd?|HH?|hh?|mm?|ss?|S{1,9}|a|E{1,3}|XXX|'[^']*'|[-/:., ])+")
#: A group that is repeated without end: matching a long text against it exhausts the stack.
REPEATED_GROUP = re.compile(r"(?<!\\)\)(?:[*+]|\{\d*,\d*\}|\{\d{3,}\})")


def _children(node) -> list:
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _name(node) -> str:
    return node.getClass().getSimpleName()


def _type(node) -> str:
    return node.dataType().simpleString()


def _uses_lambda(node) -> bool:
    return _name(node) == "NamedLambdaVariable" or any(_uses_lambda(c) for c in _children(node))


def _constant(node):
    """The value of a literal (a cast of one too), or None."""
    if _name(node) == "Cast":
        return _constant(node.child())
    if _name(node) != "Literal" or node.value() is None:
        return None
    value = node.value()
    return value if isinstance(value, int | float | bool) else value.toString()


def _whole(node) -> int | None:
    value = _constant(node)
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def _pattern(node, spark: SparkSession) -> int | None:
    """Number of groups of a literal regular expression that compiles and repeats no group; else None."""
    text = _constant(node)
    if not isinstance(text, str) or REPEATED_GROUP.search(text):
        return None
    try:
        return spark._jvm.java.util.regex.Pattern.compile(text).matcher("").groupCount()
    except Exception:  # the JVM's syntax error
        return None


def _try_mode(node, spark: SparkSession) -> bool:
    return _type(node) in FRACTIONS and _name(node) in ("Add", "Subtract", "Multiply") or node.evalMode().toString() != "ANSI"


def _cast(node, spark: SparkSession) -> bool:
    source, target, mode = _type(node.child()), _type(node), node.evalMode().toString()
    if source == "date" and target.startswith("timestamp"):
        return False  # the farthest dates have no timestamp, in no mode
    if mode == "TRY" or source.startswith("timestamp") and target == "date":
        return True
    if source == "variant":
        return target == "variant"
    can = spark._jvm.org.apache.spark.sql.catalyst.expressions.Cast.canUpCast(node.child().dataType(), node.dataType())
    return mode != "ANSI" or can or target in ("string", "variant")


def _sign(node, spark: SparkSession) -> bool:
    return _type(node) in FRACTIONS or _type(node) in WHOLE and not node.failOnError()


def _rounded(node, spark: SparkSession) -> bool:
    child, scale = _children(node)
    return _whole(scale) is not None and (_type(child) in FRACTIONS or _type(child) in WHOLE and _whole(scale) >= 0)


def _like(node, spark: SparkSession) -> bool:
    text = _constant(_children(node)[1])
    return isinstance(text, str) and not re.search(r"\\(?![%_\\])", text.replace("\\\\", ""))


def _extract(node, spark: SparkSession) -> bool:
    _, pattern, group = _children(node)
    groups, which = _pattern(pattern, spark), _whole(group)
    return groups is not None and which is not None and 0 <= which <= groups


def _replace(node, spark: SparkSession) -> bool:
    children = _children(node)
    put, start = _constant(children[2]), _whole(children[3])
    return _pattern(children[1], spark) is not None and isinstance(put, str) and not re.search(r"[$\\]", put) and start is not None and start > 0


def _regex(node, spark: SparkSession) -> bool:
    return _pattern(_children(node)[1], spark) is not None


def _count(node, spark: SparkSession) -> bool:
    n = _whole(_children(node)[0 if _name(node) == "StringSpace" else 1])
    return n is not None and n <= LONGEST


def _index(node, spark: SparkSession) -> bool:
    element = node if _name(node) != "TryElementAt" else _children(node)[0]
    values, index = _children(element)
    return not element.failOnError() and (not _type(values).startswith("array") or _whole(index) not in (None, 0))


def _slice(node, spark: SparkSession) -> bool:
    _, start, length = _children(node)
    return _whole(start) not in (None, 0) and _whole(length) is not None and _whole(length) >= 0


def _natural_order(node, spark: SparkSession) -> bool:
    """``array_sort`` by the built-in comparator: a lambda of the user's can be NULL or contradict itself."""
    by = _children(node)[1].function().sql()
    var = r"namedlambdavariable\(\)"
    less = rf"\(?IF\(\({var} < {var}\), -1, \(?IF\(\({var} > {var}\), 1, 0\)\)?\)\)?"
    return re.fullmatch(rf"\(?IF\(\(\({var} IS NULL\) AND \({var} IS NULL\)\), 0, \(?IF\(\({var} IS NULL\), 1, \(?IF\(\({var} IS NULL\), -1, {less}\)+\)?", by) is not None


def _keys(node, spark: SparkSession) -> bool:
    keys = [_constant(k) for k in _children(node)[::2]]
    return None not in keys and len(set(keys)) == len(keys)


def _parsed_time(node, spark: SparkSession) -> bool:
    children = _children(node)
    throws = node.ansiEnabled() if _name(node) == "ParseToDate" else node.failOnError()
    return not throws and (len(children) < 2 or _date_pattern(children[1])) or len(children) == 1 and _date_type(children[0])


def _date_type(node) -> bool:
    return _type(node) in ("timestamp", "timestamp_ntz", "date")


def _date_pattern(node) -> bool:
    text = _constant(node)
    return isinstance(text, str) and DATE_PATTERN.fullmatch(text) is not None


def _number_format(node, spark: SparkSession) -> bool:
    return isinstance(_constant(_children(node)[1]), str)


#: Nodes that never throw within a domain, and the test of it.
WITHIN: dict[str, Callable[..., bool]] = {
    **dict.fromkeys(("Add", "Subtract", "Multiply", "Divide", "IntegralDivide", "Remainder", "Pmod"), _try_mode),
    **dict.fromkeys(("Abs", "UnaryMinus"), _sign), **dict.fromkeys(("Round", "BRound"), _rounded),
    **dict.fromkeys(("Ceil", "Floor"), lambda node, spark: _type(_children(node)[0]) in (*FRACTIONS, *WHOLE)),
    "Cast": _cast,
    "VariantGet": lambda node, spark: (not node.failOnError() or _type(node) == "variant") and isinstance(_constant(_children(node)[1]), str),
    **dict.fromkeys(("ElementAt", "TryElementAt"), _index), "GetArrayItem": lambda node, spark: not node.failOnError(),
    "Concat": lambda node, spark: not _type(node).startswith("array") or len(_children(node)) <= 100,
    **dict.fromkeys(("Like", "ILike"), _like), **dict.fromkeys(("RLike", "StringSplit", "RegExpCount", "RegExpSubStr", "RegExpInStr"), _regex),
    **dict.fromkeys(("RegExpExtract", "RegExpExtractAll"), _extract), "RegExpReplace": _replace,
    "SubstringIndex": lambda node, spark: _whole(_children(node)[2]) is not None and abs(_whole(_children(node)[2])) < 2**31,
    "SplitPart": lambda node, spark: _whole(_children(node)[2]) not in (None, 0),
    **dict.fromkeys(("StringRepeat", "StringLPad", "StringRPad", "StringSpace", "ArrayRepeat"), _count),
    "Slice": _slice, "ArraySort": _natural_order, "CreateMap": _keys,
    **dict.fromkeys(("ParseToTimestamp", "ParseToDate"), _parsed_time),
    "DateFormatClass": lambda node, spark: _date_pattern(_children(node)[1]),
    "ParseJson": lambda node, spark: not node.failOnError(), "TryToNumber": _number_format,
    "JsonToStructs": lambda node, spark: node.options().isEmpty(),
}
#: Of these the node itself is known to be total; what it wraps is not looked at, only that node's arguments.
WRAPPED = ("TryAdd", "TrySubtract", "TryMultiply", "TryDivide", "TryMod", "TryUrlDecode", "TryParseUrl", "TryToBinary", "TryElementAt")


def _inside(node) -> list:
    """The arguments of a node; of a try form, those of what it wraps."""
    children = _children(node)
    if _name(node) in WRAPPED:
        inner = children[0]
        return _children(_children(inner)[0]) if _name(inner) == "TryEval" else _children(inner)
    return children


def _sql(node) -> str:
    """SQL of a node; Spark's own text of a variant path lacks the type."""
    text, full = node.sql(), {}
    seen = [node]
    while seen:
        x = seen.pop()
        seen += _children(x)
        if _name(x) == "VariantGet" and not x.failOnError():
            child, path = _children(x)[:2]
            typed = f"try_variant_get({child.sql()}, {path.sql()}, '{x.targetType().sql()}')"
            if full.setdefault(x.sql(), typed) != typed:
                raise ContractError(f"one path is read as two types in {text}: take the parts of the expression apart")
            text = text.replace(x.sql(), typed)
    return text


def _flag(node) -> str | None:
    """SQL of: the input of this try form is there and its result is not."""
    name = _name(node)
    if name == "Cast" and node.evalMode().toString() == "TRY":
        child = node.child()
        value, done = _sql(child), f"TRY_CAST({_sql(child)} AS {node.dataType().sql()})"
        variant = _type(child) == "variant"
    elif name == "VariantGet" and not node.failOnError() and _type(node) != "variant":
        child, path = _children(node)[:2]
        value = f"try_variant_get({_sql(child)}, {path.sql()}, 'variant')"
        done = f"try_variant_get({_sql(child)}, {path.sql()}, '{node.targetType().sql()}')"
        variant = True
    elif name in PARSERS and not _date_type(_inside(node)[0]):
        value, done, variant = _sql(_inside(node)[0]), _sql(node), False
    else:
        return None
    there = f"{value} IS NOT NULL" + (f" AND NOT is_variant_null({value})" if variant else "")
    return f"({there} AND {done} IS NULL)"


def check_expression(df: DataFrame, expression: str) -> tuple[str, object]:
    """Of an expression over ``df``: SQL of its error flag, and its type. Raises :class:`ContractError`
    unless it is known to yield a value or NULL for every row, and the same one each time."""
    spark = df.sparkSession
    analysed = df.selectExpr(f"({expression}) AS x")
    plan = analysed._jdf.queryExecution().analyzed()
    if _name(plan) != "Project" or not plan.child().equals(df._jdf.queryExecution().analyzed()):
        # generators, windows and aggregates become plan nodes of their own
        raise ContractError(f"expression {expression!r} does not give one value for one row")
    roots = plan.expressions()
    flags: list[str] = []

    def walk(node, handled: bool) -> None:
        name = _name(node)
        if not (name in TOTAL or name in WITHIN and WITHIN[name](node, spark)):
            instead = f"write {INSTEAD[name]}" if name in INSTEAD else "it is not known to yield a value for every row"
            raise ContractError(f"expression {expression!r} can fail at run time at {node.sql()}: {instead}")
        flag = None if handled or _uses_lambda(node) else _flag(node)
        if flag and flag not in flags:
            flags.append(flag)
        for child in _inside(node):
            walk(child, handled or name in HANDLED)

    for i in range(roots.size()):
        if not roots.apply(i).deterministic():
            raise ContractError(f"expression {expression!r} has another value each time it is evaluated")
        walk(roots.apply(i), False)
    for flag in flags:  # a node whose text doesn't give it back can't be flagged
        try:
            df.selectExpr(flag)
        except AnalysisException as error:
            raise ContractError(f"expression {expression!r} is too involved to tell its failures: take its parts apart ({flag})") from error
    return " OR ".join(flags) or "false", analysed.schema["x"].dataType
