"""JSON Schema keywords beyond the type, compiled to SQL expressions over VARIANT values.

``compile_keywords`` gives two forms of the same checks: one condition that good values pass, and the list of errors of those
that do not. Keywords apply to the kinds of values they are about, as in the JSON Schema drafts: a bound says nothing
about a text. A missing value passes everything; ``required`` is its parent's matter.

Numbers are compared as decimals where they fit one of 38 digits, else as doubles. Patterns are searched with Java's
regular expressions. Objects and arrays in ``enum`` and ``const`` are compared by their compact text. Keywords that are not known
are an error, except those that only describe and those named by ``ignored``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from millrace.functions import variants as V
from millrace.functions.jsonschema import type_list

# Keywords that describe and check nothing here.
DESCRIPTIVE = (
    "$schema", "$id", "id", "$comment", "title", "description", "default", "examples", "format", "readOnly", "writeOnly", "deprecated",
    "definitions", "$defs", "contentEncoding", "contentMediaType",
)
# Keywords with a check.
CHECKED = (
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "minLength", "maxLength", "pattern",
    "items", "minItems", "maxItems", "uniqueItems", "contains", "properties", "patternProperties", "additionalProperties", "required",
    "minProperties", "maxProperties", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref",
)
ERRORS = "array<struct<path:string,rule:string,message:string>>"
NONE = f"cast(array() AS {ERRORS})"
DECIMAL = "decimal(38,15)"


@dataclass
class Check:
    """One check of one value: ``good`` is true or SQL NULL when it passes; ``message`` is SQL text."""

    rule: str
    good: str
    message: str
    path: str


@dataclass
class Compiler:
    """Compiles the nodes of one schema. ``depth`` keeps the variables of nested lambdas apart."""

    root: dict
    ignored: tuple[str, ...] = ()
    open_refs: list[str] = field(default_factory=list)
    depth: int = 0

    def checks(self, value: str, node: dict | bool, path: str, with_type: bool) -> list[Check]:
        """The checks of a node and everything below it that is reached without a loop; loops are one check each."""
        if node is True or node == {}:
            return []
        if node is False:
            return [Check("false", f"{value} IS NULL", "'no value is allowed here'", path)]
        if not isinstance(node, dict):
            raise ValueError(f"A schema has to be an object or a boolean, not {node!r}.")
        unknown = [k for k in node if k not in CHECKED and k not in DESCRIPTIVE and k not in self.ignored]
        if unknown:
            raise ValueError(f"The keyword {unknown[0]!r} is not supported.")
        found = []
        if "$ref" in node:
            found += self._referred(value, node["$ref"], path, with_type)
        if with_type and "type" in node:
            kinds = type_list(node)
            fits = " OR ".join(V.is_kind(value, k) for k in kinds)
            found.append(Check("type", f"({fits})", f"concat(to_json({value}), {V.literal(' is not of type ' + ', '.join(kinds))})", path))
        found += self._of_value(value, node, path)
        found += self._of_number(value, node, path)
        found += self._of_text(value, node, path)
        found += self._of_array(value, node, path, with_type)
        found += self._of_object(value, node, path, with_type)
        found += self._combined(value, node, path)
        return found

    def good(self, value: str, node: dict | bool, with_type: bool = True) -> str:
        """One condition for a node, never NULL; true for a missing value."""
        found = [f"coalesce({c.good}, true)" for c in self.checks(value, node, "'$'", with_type)]
        if not found:
            return "true"
        return f"({value} IS NULL OR ({' AND '.join(found)}))"

    def errors(self, value: str, node: dict | bool, path: str, with_type: bool) -> str:
        """SQL array of the errors of a node, with those below loops at their own paths."""
        plain = [c for c in self.checks(value, node, path, with_type) if c.rule != "items"]
        parts = []
        if plain:
            structs = ", ".join(
                f"if(coalesce({c.good}, true), NULL, named_struct('path', {c.path}, 'rule', {V.literal(c.rule)}, 'message', {c.message}))" for c in plain
            )
            parts.append(f"filter(array({structs}), e -> e IS NOT NULL)")
        parts += self._element_errors(value, node, path, with_type)
        if not parts:
            return NONE
        return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"

    def _element_errors(self, value: str, node: dict | bool, path: str, with_type: bool) -> list[str]:
        """Errors of the elements of arrays, at whatever depth of objects the arrays lie."""
        if not isinstance(node, dict):
            return []
        parts = []
        if "$ref" in node:
            with self._resolved(node["$ref"]) as target:
                parts += self._element_errors(value, target, path, with_type)
        for key, child in node.get("properties", {}).items():
            parts += self._element_errors(V.child(value, key), child, self._below(path, key), with_type)
        for part in node.get("allOf", []):
            parts += self._element_errors(value, part, path, True)
        if isinstance(node.get("items"), dict):
            x, i = f"k{self.depth}", f"i{self.depth}"
            self.depth += 1
            inner = self.errors(x, node["items"], f"concat({path}, '[', {i}, ']')", with_type)
            self.depth -= 1
            if inner != NONE:
                parts.append(f"coalesce(flatten(transform({V.elements(value)}, ({x}, {i}) -> {inner})), {NONE})")
        return parts

    @staticmethod
    def _below(path: str, key: str) -> str:
        return f"concat({path}, {V.literal('.' + key)})"

    def _resolved(self, ref: str):
        return _Reference(self, ref)

    def _referred(self, value: str, ref: str, path: str, with_type: bool) -> list[Check]:
        with self._resolved(ref) as target:
            # The type of a node behind a reference is no part of the columns' types.
            return self.checks(value, target, path, True)

    def _of_value(self, value: str, node: dict, path: str) -> list[Check]:
        found = []
        for rule, options in (("enum", node.get("enum")), ("const", [node["const"]] if "const" in node else None)):
            if options is not None:
                if not isinstance(options, list) or not options:
                    raise ValueError("An enum needs a list of values.")
                good = " OR ".join(self._equals(value, option) for option in options)
                allowed = V.literal(" is not " + " or ".join(json.dumps(o, ensure_ascii=False) for o in options))
                found.append(Check(rule, f"({good})", f"concat(to_json({value}), {allowed})", path))
        return found

    @staticmethod
    def _equals(value: str, option) -> str:
        if option is None:
            return f"coalesce(is_variant_null({value}), false)"
        if isinstance(option, bool):
            return f"coalesce({V.is_kind(value, 'boolean')} AND try_variant_get({value}, '$', 'boolean') = {str(option).lower()}, false)"
        if isinstance(option, (int, float)):
            return f"coalesce({V.is_kind(value, 'number')} AND {_compare(value, '=', option)}, false)"
        if isinstance(option, str):
            return f"coalesce({V.is_kind(value, 'string')} AND {V.text(value)} = {V.literal(option)}, false)"
        kind = "array" if isinstance(option, list) else "object"
        text = V.literal(json.dumps(option, ensure_ascii=False))
        return f"coalesce({V.is_kind(value, kind)} AND to_json({value}) = to_json(parse_json({text})), false)"

    @staticmethod
    def _of_number(value: str, node: dict, path: str) -> list[Check]:
        found = []
        number = V.is_kind(value, "number")

        def add(rule: str, operator: str, bound, words: str) -> None:
            if isinstance(bound, bool) or not isinstance(bound, (int, float)):
                raise ValueError(f"{rule} needs a number.")
            found.append(Check(rule, f"(NOT {number} OR {_compare(value, operator, bound)})", f"concat(to_json({value}), ' is {words} {bound}')", path))

        # The first drafts made a bound exclusive by a flag beside it.
        for rule, operator, words in (("minimum", ">", "not above"), ("maximum", "<", "not below")):
            flag = node.get("exclusive" + rule.capitalize())
            if rule in node:
                strict = flag is True
                add(rule, operator if strict else f"{operator}=", node[rule], words if strict else ("below" if rule == "minimum" else "above"))
            if flag is not None and not isinstance(flag, bool):
                add("exclusive" + rule.capitalize(), operator, flag, words)
        if "multipleOf" in node:
            step = node["multipleOf"]
            if isinstance(step, bool) or not isinstance(step, (int, float)) or step <= 0:
                raise ValueError("multipleOf needs a number above zero.")
            exact, double = f"try_variant_get({value}, '$', '{DECIMAL}')", f"try_variant_get({value}, '$', 'double')"
            whole = f"coalesce({exact} % cast('{_plain(step)}' AS {DECIMAL}) = 0, abs({double} / {step}D - rint({double} / {step}D)) < 1e-9)"
            found.append(Check("multipleOf", f"(NOT {number} OR {whole})", f"concat(to_json({value}), ' is no multiple of {step}')", path))
        return found

    @staticmethod
    def _of_text(value: str, node: dict, path: str) -> list[Check]:
        found, is_text = [], V.is_kind(value, "string")
        for rule, operator, words in (("minLength", ">=", "shorter"), ("maxLength", "<=", "longer")):
            if rule in node:
                good = f"(NOT {is_text} OR char_length({V.text(value)}) {operator} {int(node[rule])})"
                found.append(Check(rule, good, f"concat(to_json({value}), ' is {words} than {int(node[rule])} characters')", path))
        if "pattern" in node:
            good = f"(NOT {is_text} OR {V.text(value)} RLIKE {V.literal(node['pattern'])})"
            found.append(Check("pattern", good, f"concat(to_json({value}), {V.literal(' does not match ' + node['pattern'])})", path))
        return found

    def _of_array(self, value: str, node: dict, path: str, with_type: bool) -> list[Check]:
        found, elements = [], V.elements(value)
        for rule, operator, words in (("minItems", ">=", "fewer"), ("maxItems", "<=", "more")):
            if rule in node:
                count = int(node[rule])
                found.append(Check(rule, f"size({elements}) {operator} {count}", f"concat(size({elements}), ' elements are {words} than {count}')", path))
        if node.get("uniqueItems"):
            texts = f"transform({elements}, u -> to_json(u))"
            found.append(Check("uniqueItems", f"size(array_distinct({texts})) = size({elements})", "'elements are repeated'", path))
        for rule, test in (("items", "forall"), ("contains", "exists")):
            if rule not in node:
                continue
            if isinstance(node[rule], list):
                raise ValueError(f"A list of schemas in {rule!r} is not supported.")
            x = f"k{self.depth}"
            self.depth += 1
            inner = self.good(x, node[rule], with_type or rule == "contains")
            self.depth -= 1
            if inner != "true" or rule == "contains":
                found.append(Check(rule, f"{test}({elements}, {x} -> {inner})", f"'an element does not fit {rule}'", path))
        return found

    def _of_object(self, value: str, node: dict, path: str, with_type: bool) -> list[Check]:
        found = []
        for key in node.get("required", []) if isinstance(node.get("required"), list) else []:
            good = f"(NOT {V.is_kind(value, 'object')} OR {V.child(value, key)} IS NOT NULL)"
            found.append(Check("required", good, V.literal(f"{key} is missing"), self._below(path, key)))
        entries = f"map_entries(try_variant_get({value}, '$', 'map<string,variant>'))"
        for rule, operator, words in (("minProperties", ">=", "fewer"), ("maxProperties", "<=", "more")):
            if rule in node:
                count = int(node[rule])
                found.append(Check(rule, f"size({entries}) {operator} {count}", f"concat(size({entries}), ' properties are {words} than {count}')", path))
        properties, patterns = node.get("properties", {}), node.get("patternProperties", {})
        for key, child in properties.items():
            own = self.checks(V.child(value, key), child, self._below(path, key), with_type)
            found += [Check(c.rule, f"({V.child(value, key)} IS NULL OR coalesce({c.good}, true))", c.message, c.path) for c in own]
        p = f"p{self.depth}"
        for pattern, child in patterns.items():
            self.depth += 1
            inner = self.good(f"{p}.value", child)
            self.depth -= 1
            good = f"forall({entries}, {p} -> NOT {p}.key RLIKE {V.literal(pattern)} OR {inner})"
            found.append(Check("patternProperties", good, V.literal(f"a property like {pattern} does not fit"), path))
        more = node.get("additionalProperties", True)
        if more is not True and more != {}:
            known = [f"array_contains(array({', '.join(V.literal(k) for k in properties)}), {p}.key)"] if properties else []
            known += [f"{p}.key RLIKE {V.literal(pattern)}" for pattern in patterns]
            self.depth += 1
            known.append("false" if more is False else self.good(f"{p}.value", more))
            self.depth -= 1
            good = f"forall({entries}, {p} -> {' OR '.join(known)})"
            names = f"array_join(transform(filter({entries}, {p} -> NOT ({' OR '.join(known)})), {p} -> {p}.key), ', ')"
            found.append(Check("additionalProperties", good, f"concat('not allowed: ', {names})", path))
        return found

    def _combined(self, value: str, node: dict, path: str) -> list[Check]:
        found = []
        for part in node.get("allOf", []):
            found += self.checks(value, part, path, True)
        if "anyOf" in node:
            good = " OR ".join(self.good(value, part) for part in node["anyOf"])
            found.append(Check("anyOf", f"({good})", f"concat(to_json({value}), ' fits none of the choices')", path))
        if "oneOf" in node:
            hits = " + ".join(f"if({self.good(value, part)}, 1, 0)" for part in node["oneOf"])
            found.append(Check("oneOf", f"({hits}) = 1", f"concat(to_json({value}), ' fits ', {hits}, ' of the choices, not one')", path))
        if "not" in node:
            found.append(Check("not", f"NOT {self.good(value, node['not'])}", f"concat(to_json({value}), ' is excluded')", path))
        if "if" in node:
            when = self.good(value, node["if"])
            for rule, test in (("then", f"NOT {when}"), ("else", when)):
                if rule in node:
                    found.append(Check(rule, f"({test} OR {self.good(value, node[rule])})", f"concat(to_json({value}), ' does not fit {rule}')", path))
        return found


class _Reference:
    """The node a local reference names, for as long as it is compiled; a reference to itself is refused."""

    def __init__(self, compiler: Compiler, ref: str):
        self.compiler, self.ref = compiler, ref

    def __enter__(self) -> dict | bool:
        if not self.ref.startswith("#"):
            raise ValueError(f"The reference {self.ref} is not local.")
        if self.ref in self.compiler.open_refs:
            raise ValueError(f"The reference {self.ref} leads to itself.")
        node: object = self.compiler.root
        for step in [s.replace("~1", "/").replace("~0", "~") for s in self.ref[1:].split("/") if s]:
            if isinstance(node, list) and step.isdigit() and int(step) < len(node):
                node = node[int(step)]
            elif isinstance(node, dict) and step in node:
                node = node[step]
            else:
                raise ValueError(f"The reference {self.ref} leads nowhere.")
        self.compiler.open_refs.append(self.ref)
        return node

    def __exit__(self, *_) -> None:
        self.compiler.open_refs.pop()


def _plain(number: int | float) -> str:
    """A number without an exponent."""
    from decimal import Decimal

    return format(Decimal(repr(number)), "f")


def _compare(value: str, operator: str, bound: int | float) -> str:
    """Comparison as decimals, or as doubles where the value is too large for one."""
    text = _plain(bound)
    exact = f"try_variant_get({value}, '$', '{DECIMAL}') {operator} try_cast('{text}' AS {DECIMAL})"
    return f"coalesce({exact}, try_variant_get({value}, '$', 'double') {operator} cast('{text}' AS double))"


def compile_keywords(schema: dict, ignored: tuple[str, ...] = (), value: str = "data") -> tuple[str, str]:
    """SQL texts over ``value``, a VARIANT: whether a record passes all keywords, and the array of its errors.

    The types of columns are checked elsewhere; types inside combinations and behind references are checked here.
    """
    good = Compiler(schema, ignored).good(value, schema, with_type=False)
    errors = Compiler(schema, ignored).errors(value, schema, "'$'", with_type=False)
    return V.share(value, good), V.share(value, errors)
