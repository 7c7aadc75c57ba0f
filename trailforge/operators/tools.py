"""The tool catalogue: a constant relation, its guards, its identity, arguments and command lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ConfigError
from ..functions.keys import sha256_text
from ..functions.text import canonical, spaced
from ..schemas import CATALOGUE_VERSION

# Name, required arguments, optional arguments, execution, command template, output budget.
CATALOGUE = (
    ("read_file", ("path",), (), "rtk_read", "rtk read {path}", 20_000),
    ("write_file", ("path", "content"), (), "raw", "", 20_000),
    ("edit_file", ("path", "old_string", "new_string"), (), "raw", "", 4_000),
    ("grep", ("pattern",), ("path",), "rtk", "rtk grep -r {pattern} {path}", 8_000),
    ("go_build", ("pkg",), (), "rtk", "rtk go build {pkg}", 8_000),
    ("go_test", ("pkg",), (), "rtk", "rtk go test {pkg}", 12_000),
    ("rtk_recall", ("hash",), (), "raw", "rtk recall --full {hash}", 20_000),
    ("go_doc", ("symbol",), (), "raw", "go doc {symbol}", 6_000),
    ("go_mod_tidy", (), (), "raw", "go mod tidy", 4_000),
)
# What the model reads about each tool, and about its arguments.
ABOUT = {
    "read_file": "Read a Go source file. Returns the file contents verbatim, including package clause, imports and comments. Use this before editing a file.",
    "write_file": "Create or overwrite a file with the given contents. Use for new files only; prefer edit_file for changes to existing files.",
    "edit_file": "Replace an exact, unique string in a file. The old_string must appear exactly once; include enough surrounding context to make it unique.",
    "grep": "Search the repository with a regular expression. Returns matching lines grouped by file, truncated for length. Searches recursively, so a directory finds matches in everything beneath it.",
    "go_build": "Compile Go packages. Returns compiler errors and warnings only; a successful build produces no output.",
    "go_test": "Run Go tests for a package pattern. Returns failures and their output; a passing package is summarised rather than listed line by line.",
    "rtk_recall": "Retrieve the full output that a compressed command elided. When a tool result ends with '[full output: rtk recall <hash>]', pass that hash here to see what was cut. A unique prefix is enough. Only useful immediately after reading a compressed result: the stored output is overwritten as commands run.",
    "go_doc": "Show documentation for a Go symbol: signature, doc comment, and available methods. Use before calling an unfamiliar standard library function.",
    "go_mod_tidy": "Run go mod tidy to add missing or remove unused module requirements. Takes no arguments.",
}
ARGUMENTS = {
    "read_file": {"path": "Repo-relative path to a Go file"},
    "write_file": {"path": "Repo-relative path to write", "content": "Full file contents"},
    "edit_file": {"path": "Repo-relative path to edit", "old_string": "Exact text to replace, including indentation", "new_string": "Replacement text"},
    "grep": {"pattern": "Go regular expression", "path": "Repo-relative directory to search (default: whole repo)"},
    "go_build": {"pkg": "Package pattern, e.g. ./... or ./parser"},
    "go_test": {"pkg": "Package pattern, e.g. ./... or ./parser"},
    "rtk_recall": {"hash": "Hash from a '[full output: ...]' hint"},
    "go_doc": {"symbol": "Symbol, e.g. errors.Is or sync.Mutex"},
    "go_mod_tidy": {},
}
NAMES = tuple(x[0] for x in CATALOGUE)
HANDLERS = ("write_file", "edit_file")


def parameters(name: str) -> dict:
    """The JSON schema of a tool's arguments: strings only, and no others."""
    _, required, *_ = next(x for x in CATALOGUE if x[0] == name)
    return {"type": "object", "properties": {a: {"type": "string", "description": t} for a, t in ARGUMENTS[name].items()}, "required": list(required), "additionalProperties": False}


def function_specs() -> list[dict]:
    """The catalogue as chat models are offered it."""
    return [{"type": "function", "function": {"name": n, "description": ABOUT[n], "parameters": parameters(n)}} for n in NAMES]


def catalogue(spark) -> DataFrame:
    rows = [(n, ABOUT[n], list(r), list(o), e, t, b, spaced(parameters(n))) for n, r, o, e, t, b in CATALOGUE]
    return spark.createDataFrame(rows, "name string, description string, required array<string>, optional array<string>, execution string, template string, budget int, input_schema string")


def catalogue_sha() -> str:
    """Changes with names, descriptions, arguments, execution and budgets; not with command templates."""
    return sha256_text(canonical({"catalog_version": CATALOGUE_VERSION, "tools": [{"name": n, "description": ABOUT[n], "parameters": parameters(n), "execution": e, "output_budget_chars": b} for n, _, _, e, _, b in CATALOGUE]}))


def guard(rows=CATALOGUE, handlers=HANDLERS) -> None:
    """Each tool has a command or a handler; none rewrites output by `rtk smart`."""
    for name, _, _, _, template, _ in rows:
        if "rtk smart" in template:
            raise ConfigError(f"{name}: the summarising command is not allowed")
        if not template and name not in handlers:
            raise ConfigError(f"{name}: neither a command nor a handler")


def binaries(rows=CATALOGUE) -> list[str]:
    """Programs that the templates call, once each, in order."""
    return list(dict.fromkeys(t.split(" ")[0] for *_, t, _ in rows if t))


def argument_problem(required: Column, optional: Column, arguments: Column) -> Column:
    """missing / unexpected / not_a_string with the names, or null. arguments: JSON text of an object."""
    parsed = F.from_json(arguments, "map<string,variant>")
    keys = F.map_keys(parsed)
    lacking, beyond = F.array_except(required, keys), F.array_except(keys, F.concat(required, optional))
    other = F.filter(keys, lambda k: F.schema_of_variant(F.element_at(parsed, k)) != "STRING")
    said = lambda word, names: F.concat(F.lit(word + ": "), F.array_join(F.array_sort(names), ", "))
    return F.when(parsed.isNull(), F.lit("no object")).when(F.size(lacking) > 0, said("missing", lacking)).when(F.size(beyond) > 0, said("unexpected", beyond)).when(F.size(other) > 0, said("not_a_string", other))


def argv(template: Column, arguments: Column) -> Column:
    """One entry per word of the template; {name} takes an argument whole, '' where it is absent. arguments: a map."""
    one = lambda t: F.when(t.rlike(r"^\{\w+\}$"), F.coalesce(F.try_element_at(arguments, F.regexp_extract(t, r"\w+", 0)), F.lit(""))).otherwise(t)
    return F.when(template == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(template, " "), one))
