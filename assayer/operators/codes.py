"""Potential code errors: codes whose content or length is unexpected for their type."""

from __future__ import annotations

from dataclasses import dataclass, field as dataclass_field

from assayer import model
from assayer.functions.exprs import flag, name, text, texts
from assayer.model import Check
from assayer.operators.row import Measure


@dataclass(frozen=True)
class CodeRule:
    """Rule for one code type; a code collects one flag per part it breaks.

    ``alpha``/``numeric``: pattern the code must not match.  ``digits``: the code must
    hold a digit, and a NULL code does not.  ``length``: inclusive range without dots,
    upper end None for open.  ``dummies``: placeholder codes.  ``check_digit``: one
    character must follow the first hyphen.
    """

    code_type: str
    alpha: str | None = None
    numeric: str | None = None
    digits: bool = False
    length: tuple[int, int | None] | None = None
    dummies: list[str] = dataclass_field(default_factory=list)
    check_digit: bool = False


@dataclass(frozen=True)
class CodeTable:
    code: str
    type_field: str | None
    scale: str
    rules: list[CodeRule]


# ---- fixed values of the code rules --------------------------------------------
ANY_LETTER = "[a-zA-Z]"
ICD_RULES = [
    CodeRule("09", alpha="^[A-DF-UW-Z]", length=(3, 5), dummies=["000"]),
    CodeRule("10", numeric="^[0-9]", length=(3, 7), dummies=["000", "999"]),
]
CODE_TABLES = {
    "DIAGNOSIS": CodeTable("DX", "DX_TYPE", "pct2", ICD_RULES),
    "PROCEDURES": CodeTable("PX", "PX_TYPE", "pct2", [
        CodeRule("09", alpha=ANY_LETTER, digits=True, length=(3, 4)),
        CodeRule("10", digits=True, length=(7, 7), dummies=["0000000", "9999999"]),
        CodeRule("CH", digits=True, length=(5, None), dummies=["00000", "99999"]),
    ]),
    "CONDITION": CodeTable("CONDITION", "CONDITION_TYPE", "pct2", ICD_RULES),
    "PRESCRIBING": CodeTable("RXNORM_CUI", None, "pct0", [
        CodeRule("RX", alpha=ANY_LETTER, length=(2, 7)),
    ]),
    "DISPENSING": CodeTable("NDC", None, "pct0", [
        CodeRule("NC", alpha=ANY_LETTER, length=(11, 11),
                 dummies=["00000000000", "99999999999"]),
    ]),
    "LAB_RESULT_CM": CodeTable("LAB_LOINC", None, "pct0", [
        CodeRule("LC", alpha=ANY_LETTER, length=(3, 7), check_digit=True),
    ]),
    "IMMUNIZATION": CodeTable("VX_CODE", "VX_CODE_TYPE", "pct2", [
        CodeRule("CH", digits=True, length=(5, None), dummies=["00000", "99999"]),
        CodeRule("CX", alpha=ANY_LETTER, digits=True, length=(2, 3), dummies=["000", "999"]),
        CodeRule("RX", alpha=ANY_LETTER, digits=True, length=(2, 7)),
    ]),
}
# --------------------------------------------------------------------------------


def _flags(code: str, rule: CodeRule) -> list[str]:
    """0/1 expressions, one per part of the rule the code may break."""
    found = []
    if rule.alpha:
        found.append(flag(f"{code} rlike {text(rule.alpha)}"))
    if rule.numeric:
        found.append(flag(f"{code} rlike {text(rule.numeric)}"))
    if rule.digits:
        found.append(flag(f"not coalesce({code} rlike '[0-9]', false)"))
    if rule.length:
        low, high = rule.length
        size = f"length(replace({code}, '.', ''))"
        found.append(flag(f"{size} < {low}" if high is None else f"{size} not between {low} and {high}"))
    if rule.dummies:
        found.append(flag(f"{code} in {texts(rule.dummies)}"))
    if rule.check_digit:
        found.append(flag(f"length({code}) - instr({code}, '-') <> 1"))
    return found


def code_errors(table: str, test: str = "DC 1.13", min_flags: int = 1) -> list[Measure]:
    """One measure per reported code type.

    A code is an error when it breaks at least ``min_flags`` parts of its rule.  The
    types are few and fixed, so they are counted side by side without a shuffle by type.
    """
    spec = CODE_TABLES[table.upper().removesuffix("_STG")]
    code = name(spec.code)
    out = []
    for rule in spec.rules:
        of_type = "true" if spec.type_field is None else f"{name(spec.type_field)} = {text(rule.code_type)}"
        broken = f"({' + '.join(_flags(code, rule))}) >= {min_flags}"
        message = (
            f"{{value}} percent of {table} codes of type {rule.code_type}"
            " have unexpected length or content."
        )
        check = Check(test, table, spec.code, rule.code_type, model.CODE_ERROR_PCT,
                      spec.scale, "above", message)
        out.append(Measure(check, f"{of_type} and {broken}", f"{of_type} and {code} is not null", of_type))
    return out
