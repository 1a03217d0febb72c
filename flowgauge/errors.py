"""Error contract: every failure a caller can act on carries a code."""

from __future__ import annotations

from collections.abc import Iterable

INCOMPLETE_PARAMETERS = "INCOMPLETE_PARAMETERS"
BAD_INPUTPARAMETER = "BAD_INPUTPARAMETER"
DATE_PARSING_ERROR = "DATE_PARSING_ERROR"
DATABASE_NOT_MATCH = "DATABASE_NOT_MATCH"


class KpiError(ValueError):
    """Raised on the driver while a plan is built."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code
        self.message = message


def incomplete(message: str) -> KpiError:
    return KpiError(INCOMPLETE_PARAMETERS, message)


def bad_input(message: str) -> KpiError:
    return KpiError(BAD_INPUTPARAMETER, message)


def is_blank(value: str | None) -> bool:
    """A missing or blank optional argument means "no filter"."""
    return value is None or not str(value).strip()


def required(value: str | None, what: str) -> str:
    if is_blank(value):
        raise incomplete(f"{what} is required")
    return value


def no_choice(what: str, value: object, allowed: Iterable[str]) -> KpiError:
    return bad_input(f"choose the {what} among {', '.join(allowed)}; {value!r} is none of them")


def one_of(value: str, allowed: Iterable[str], what: str) -> str:
    """The upper-case name of an option, whatever its spelling."""
    name = value.strip().upper()
    if name not in allowed:
        raise no_choice(what, value, allowed)
    return name
