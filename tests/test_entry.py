"""The driver contract, with and without the optional part and the libraries it needs."""

from __future__ import annotations

import builtins
import sys

import pytest

import __spark_entry__ as entry
from shoplane.plans.registry import ORACLE, QUERIES


def without(monkeypatch, *missing):
    """Imports of these modules fail as for a module that is not installed."""
    for name in [m for m in sys.modules if m.startswith(("shoplane.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    import shoplane
    monkeypatch.delattr(shoplane, "llm", raising=False)
    real = builtins.__import__

    def imports(name, globals=None, locals=None, fromlist=(), level=0):
        full = name if not level else ".".join([*(globals or {}).get("__package__", "").split(".")[:None if level == 1 else 1 - level], *([name] if name else [])])
        for m in missing:
            if full == m or full.startswith(m + "."):
                raise ModuleNotFoundError(f"No module named {m!r}", name=m)
        return real(name, globals, locals, fromlist, level)
    monkeypatch.setattr(builtins, "__import__", imports)


@pytest.mark.parametrize("missing", ["shoplane.llm", "xxhash", "tokenizers.none", "public_tokenizers", "regex.none"])
def test_analytics_queries_are_always_there(monkeypatch, missing):
    without(monkeypatch, missing)
    import warnings
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        queries, sql = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(ORACLE) <= set(sql)
    told = [str(w.message) for w in said if "training-data" in str(w.message)]
    if missing in ("xxhash", "public_tokenizers") and told:
        assert missing in told[0]
    if missing == "shoplane.llm":
        assert not told and set(queries) == set(QUERIES)


def test_a_missing_module_of_the_library_is_an_error(monkeypatch):
    pytest.importorskip("shoplane.llm.queries", exc_type=ImportError)
    without(monkeypatch, "shoplane.session")
    with pytest.raises(ModuleNotFoundError):
        entry._llm()
