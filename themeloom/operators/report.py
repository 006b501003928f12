"""The evaluation report, from the one-row results of the metrics."""

from __future__ import annotations


def half_even(n: int, of: int) -> str:
    """A whole percentage with Python's half-even rounding; n/a without a denominator."""
    return f"{n / of * 100:.0f}%" if of else "n/a"


def render(confusion: dict[tuple[bool, bool], int], m: dict[str, int]) -> str:
    """Markdown: confusion[(model, gold)] and the counts of matching.metrics."""
    both, model, gold, none = (confusion.get(k, 0) for k in ((True, True), (True, False), (False, True), (False, False)))
    n = both + model + gold + none
    lines = ["| | gold issue | no gold issue |", "|---|---|---|", f"| model issue | {both} | {model} |", f"| no model issue | {gold} | {none} |", "", f"Agreement: {both + none}/{n} = {half_even(both + none, n)}", ""]
    lines += ["| metric | count | share |", "|---|---|---|", f"| issue precision | {m['n_matched']}/{m['n_model']} | {half_even(m['n_matched'], m['n_model'])} |"]
    names = {"area_strict": "feature area, strict", "area_parent": "feature area, parent", "severity_exact": "severity, exact", "severity_within_one": "severity, within one"}
    lines += [f"| {label} | {m[k]}/{m['n_matched']} | {half_even(m[k], m['n_matched'])} |" for k, label in names.items()]
    return "\n".join(lines)
