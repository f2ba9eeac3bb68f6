"""The entry offers the rating analytics whatever the optional package lacks."""

import importlib

import pytest

import __spark_entry__ as entry


def test_a_package_that_is_not_there(monkeypatch):
    assert entry._optional("reelscope_is_not_installed") is None


def _raises(name):
    def load(module):
        raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    return load


def test_a_missing_third_party_module_leaves_the_rest(monkeypatch):
    monkeypatch.setattr(importlib, "import_module", _raises("numpy.linalg"))
    assert entry._optional("reelscope.plans") is None


@pytest.mark.parametrize("name", ["reelscope.gone", "corpus_pipeline"])
def test_errors_of_our_own_modules_are_raised(monkeypatch, name):
    monkeypatch.setattr(importlib, "import_module", _raises(name))
    with pytest.raises(ModuleNotFoundError):
        entry._optional("reelscope.plans")
