"""Condition/action rules compiled to columns."""

from __future__ import annotations

import copy
import functools
import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c, let

# The ten shipped scoring rules, in the JSON layout users write their own in.
SHIPPED_RULES: list[dict] = [
    {
        "description": "mimikatz command line args",
        "conditions": {
            "any": [
                {"name": "command_line", "operator": "contains", "value": "sekurlsa"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 1.0},
            },
            {
                "name": "append_to_property",
                "params": {"name": "techniques", "value": "https://attack.mitre.org/techniques/T1075/"},
            },
        ],
    },
    {
        "description": "Accessibility features",
        "conditions": {
            "any": [
                {"name": "binary_ref.name", "operator": "equal_to", "value": "sethc.exe"},
                {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "osk.exe"},
                {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "Magnify.exe"},
                {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "Narrator.exe"},
                {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "DisplaySwitch.exe"},
                {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "AtBroker.exe"},
            ],
        },
        "actions": [
            {
                "name": "append_to_property",
                "params": {"name": "techniques", "value": "https://attack.mitre.org/techniques/T1015/"},
            },
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 1},
            },
        ],
    },
    {
        "description": "encoded powershell",
        "conditions": {
            "all": [
                {"name": "binary_ref.name", "operator": "equal_to", "value": "powershell.exe"},
                {"name": "command_line", "operator": "matches_regex", "value": " -[Ee][Nn][Cc]"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 2},
            },
            {
                "name": "append_to_property",
                "params": {"name": "techniques", "value": "https://attack.mitre.org/techniques/T1086/"},
            },
        ],
    },
    {
        "description": "potential powershell downgrade",
        "conditions": {
            "all": [
                {"name": "binary_ref.name", "operator": "equal_to", "value": "powershell.exe"},
                {"name": "command_line", "operator": "matches_regex", "value": " -[Vv][Ee]"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 1},
            },
            {
                "name": "append_to_property",
                "params": {"name": "techniques", "value": "https://attack.mitre.org/techniques/T1059/001/"},
            },
        ],
    },
    {
        "description": "net use",
        "conditions": {
            "any": [
                {"name": "command_line", "operator": "contains", "value": "net use"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 1},
            },
        ],
    },
    {
        "description": "Account Discovery",
        "conditions": {
            "any": [
                {"name": "command_line", "operator": "contains", "value": "net user"},
                {"name": "command_line", "operator": "contains", "value": "net group"},
                {"name": "command_line", "operator": "contains", "value": "net localgroup"},
                {"name": "command_line", "operator": "contains", "value": "whoami"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 1},
            },
            {
                "name": "append_to_property",
                "params": {"name": "techniques", "value": "https://attack.mitre.org/techniques/T1087/"},
            },
        ],
    },
    {
        "description": "suspicious registry modification",
        "conditions": {
            "all": [
                {"name": "type", "operator": "equal_to", "value": "windows-registry-key"},
                {"name": "key", "operator": "matches_regex", "value": "^(.*)BackgroundAccessApplications"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 1},
            },
        ],
    },
    {
        "description": "binary in temp dir",
        "conditions": {
            "any": [
                {"name": "binary_ref.parent_directory_ref.path", "operator": "equal_to", "value": "C:\\"},
                {"name": "binary_ref.parent_directory_ref.path", "operator": "matches_regex", "value": "C:\\\\Users\\\\[A-Za-z][A-Za-z0-9_]*\\\\AppData\\\\Local\\\\Temp"},
                {"name": "binary_ref.parent_directory_ref.path", "operator": "equal_to", "value": "C:\\Windows\\TEMP"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 2},
            },
        ],
    },
    {
        "description": "MS Office spawns shell",
        "conditions": {
            "all": [
                {
                    "any": [
                        {"name": "binary_ref.name", "operator": "equal_to", "value": "cmd.exe"},
                        {"name": "binary_ref.name", "operator": "equal_to", "value": "powershell.exe"},
                    ],
                },
                {
                    "any": [
                        {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "WINWORD.EXE"},
                        {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "EXCEL.EXE"},
                        {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "POWERPNT.EXE"},
                        {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "MSACCESS.EXE"},
                        {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "OUTLOOK.EXE"},
                        {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "VISIO.EXE"},
                    ],
                },
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 2},
            },
        ],
    },
    {
        "description": "node forks something that is not node",
        "conditions": {
            "all": [
                {"name": "parent_ref.binary_ref.name", "operator": "equal_to", "value": "node"},
                {"name": "binary_ref.name", "operator": "not_equal_to", "value": "node"},
            ],
        },
        "actions": [
            {
                "name": "increment_property",
                "params": {"name": "x_suspicious_score", "value": 3},
            },
        ],
    },
]


def shipped_rules() -> list[dict]:
    """A copy of the shipped rules."""
    return copy.deepcopy(SHIPPED_RULES)


# -- condition operators ------------------------------------------------------------


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def rule_contains(value: Column, literal: str) -> Column:
    return _text(value).contains(literal)


def rule_equal_to(value: Column, literal: str) -> Column:
    return _text(value) == literal


def rule_not_equal_to(value: Column, literal: str) -> Column:
    """True for a missing value: missing text counts as the empty string."""
    return _text(value) != literal


def rule_matches_regex(value: Column, literal: str) -> Column:
    return _text(value).rlike(literal)


def rule_starts_with(value: Column, literal: str) -> Column:
    return _text(value).startswith(literal)


def rule_ends_with(value: Column, literal: str) -> Column:
    return _text(value).endswith(literal)


def rule_non_empty(value: Column, literal: str) -> Column:
    return _text(value) != ""


_COMPARISONS = {
    "equal_to": operator.eq,
    "greater_than": operator.gt,
    "greater_than_or_equal_to": operator.ge,
    "less_than": operator.lt,
    "less_than_or_equal_to": operator.le,
}


def rule_numeric_ops(name: str, value: Column, literal: float) -> Column:
    """A numeric comparison by operator name; a missing number never matches."""
    return F.coalesce(_COMPARISONS[name](value, F.lit(literal)), F.lit(False))


TEXT_OPERATORS: dict[str, Callable[[Column, str], Column]] = {
    "contains": rule_contains,
    "equal_to": rule_equal_to,
    "not_equal_to": rule_not_equal_to,
    "matches_regex": rule_matches_regex,
    "starts_with": rule_starts_with,
    "ends_with": rule_ends_with,
    "non_empty": rule_non_empty,
}
NUMERIC_OPERATORS: dict[str, Callable[[Column, float], Column]] = {
    name: functools.partial(rule_numeric_ops, name) for name in _COMPARISONS
}


def rule_register_operator(name: str, fn: Callable[[Column, object], Column], numeric: bool = False):
    """Make ``fn(column, literal)`` available to rules under ``name``."""
    (NUMERIC_OPERATORS if numeric else TEXT_OPERATORS)[name] = fn


# -- actions: each returns the changed name -> column state ---------------------------

State = dict[str, "Column | Appended | Increased"]


def rule_set_property(state: State, name: str, value, hit: Column) -> State:
    old = state.get(name, F.lit(None))
    return {**state, name: F.when(hit, F.lit(value)).otherwise(old)}


@dataclass(frozen=True)
class Increased:
    """A property that rules add to; the parts are summed pairwise, at the end."""

    old: Column
    parts: tuple[Column, ...]

    def column(self) -> Column:
        parts = list(self.parts)
        while len(parts) > 1:
            pairs = [a + b for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        return self.old + parts[0]


def rule_increment_property(state: State, name: str, value: float, hit: Column) -> State:
    held = state.get(name, F.lit(0))
    held = held if isinstance(held, Increased) else Increased(held, ())
    return {**state, name: Increased(held.old, (*held.parts, F.when(hit, F.lit(value)).otherwise(F.lit(0))))}


def rule_decrement_property(state: State, name: str, value: float, hit: Column) -> State:
    return rule_increment_property(state, name, -value, hit)


def append_token(tokens: Column, token: str | Column) -> Column:
    """Add a token to a space-separated set; the set is kept in sorted order."""
    token = F.lit(token) if isinstance(token, str) else token
    parts = F.array_append(F.split(F.coalesce(tokens, F.lit("")), " "), token)
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda t: t != ""))), " ")


@dataclass(frozen=True)
class Appended:
    """A property to which rules append tokens; they are put in once, at the end."""

    old: Column
    tokens: tuple[Column, ...]

    def column(self) -> Column:
        new = F.array_compact(F.array(*self.tokens))

        def joined(given: Column) -> Column:
            old, added = given["old"], given["new"]
            parts = F.filter(F.concat(F.split(F.coalesce(old, F.lit("")), " "), added), lambda t: t != "")
            return F.when(F.size(added) == 0, old).otherwise(F.array_join(F.array_sort(F.array_distinct(parts)), " "))

        return let(F.struct(self.old.cast("string").alias("old"), new.alias("new")), joined)


def rule_append_to_property(state: State, name: str, value: str, hit: Column) -> State:
    """Add a token to a space-separated set, kept in sorted order."""
    held = state.get(name, F.lit(""))
    held = held if isinstance(held, Appended) else Appended(held, ())
    return {**state, name: Appended(held.old, (*held.tokens, F.when(hit, F.lit(value))))}


ACTIONS = {
    "set_property": rule_set_property,
    "increment_property": rule_increment_property,
    "decrement_property": rule_decrement_property,
    "append_to_property": rule_append_to_property,
}


#: What an action may add to without making a column of it first.
KEPT_OPEN = {"append_to_property": Appended, "increment_property": Increased, "decrement_property": Increased}


# -- compilation ----------------------------------------------------------------------


def _variable_type(literal) -> str:
    if isinstance(literal, str):
        return "text"
    if isinstance(literal, (int, float)) and not isinstance(literal, bool):
        return "number"
    raise TypeError(f"rule literal {literal!r} is neither number nor text")


def rules_compile(rules: Iterable[dict]) -> list[tuple[Callable[[State], Column], list[dict]]]:
    """Turn JSON rules into (condition over a state, actions) pairs.

    The type of a variable is learned from the first literal it is compared with.
    """
    types: dict[str, str] = {}

    def names(node: dict) -> set[str]:
        below = [n for kind in ("any", "all") for n in node.get(kind, [])]
        return set().union(*map(names, below)) if "name" not in node else {node["name"]}

    def condition(node: dict) -> Callable[[State], Column]:
        for kind, fold in (("any", operator.or_), ("all", operator.and_)):
            if kind in node:
                parts = [condition(n) for n in node[kind]]
                empty = F.lit(kind == "all")
                return lambda state: functools.reduce(fold, [p(state) for p in parts], empty)
        name, literal = node["name"], node["value"]
        kind = types.setdefault(name, _variable_type(literal))
        operators = TEXT_OPERATORS if kind == "text" else NUMERIC_OPERATORS
        if node["operator"] not in operators:
            raise ValueError(f"unknown {kind} operator {node['operator']!r}")
        test = operators[node["operator"]]
        missing = F.lit("") if kind == "text" else F.lit(None).cast("double")
        return lambda state: test(state.get(name, missing), literal)

    compiled = []
    for rule in rules:
        test = condition(rule["conditions"])
        test.reads = names(rule["conditions"])
        compiled.append((test, rule["actions"]))
    return compiled


def apply_compiled(state: State, compiled: Sequence) -> State:
    """Fold rules over a state; later rules see the properties earlier ones changed."""
    for condition, actions in compiled:
        hit = condition(state)
        for action in actions:
            name = action["params"]["name"]
            held, kept = state.get(name), KEPT_OPEN.get(action["name"])
            if isinstance(held, (Appended, Increased)) and not (kept and isinstance(held, kept)):
                state = {**state, name: held.column()}
            state = ACTIONS[action["name"]](state, **action["params"], hit=hit)
    return {name: value.column() if isinstance(value, (Appended, Increased)) else value for name, value in state.items()}


def score_rules(
    df: DataFrame, rules: Iterable[dict] | None = None, keep_techniques: bool = False
) -> DataFrame:
    """Apply rules to every row in one projection.

    ``x_suspicious_score`` is replaced; ``techniques`` is added on request, other
    properties that rules set are always kept.
    """
    compiled = rules_compile(shipped_rules() if rules is None else rules)
    before: State = {name: c(name) for name in df.columns}
    before.setdefault("x_suspicious_score", F.lit(0))
    before["x_suspicious_score"] = before["x_suspicious_score"].cast("double")
    # where a condition reads what earlier rules changed, these changes become columns first
    state, changed, waiting, rows = before, set(), [], df
    for test, actions in compiled:
        if test.reads & changed:
            rows = rows.select(*[column.alias(name) for name, column in apply_compiled(state, waiting).items()])
            state, changed, waiting = {name: c(name) for name in rows.columns}, set(), []
        waiting.append((test, actions))
        changed |= {action["params"]["name"] for action in actions}
    after = apply_compiled(state, waiting)
    if not keep_techniques and "techniques" not in df.columns:
        after.pop("techniques", None)
    return rows.select(*[column.alias(name) for name, column in after.items()])
