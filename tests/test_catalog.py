"""Registered queries call their operators with the whole job."""

import inspect

import pytest

from quarry import config as C
from quarry.operators import mi_knn, models, selection
from quarry.plans import catalog, pipeline


class Called(Exception):
    pass


def call(monkeypatch, module, name, query):
    """The arguments, defaults included, with which a query calls an operator."""
    real = inspect.signature(getattr(module, name))

    def record(*args, **kw):
        bound = real.bind(*args, **kw)
        bound.apply_defaults()
        raise Called(bound.arguments)

    class Any:
        def __getattr__(self, _):
            return lambda *a, **k: self

    monkeypatch.setattr(module, name, record)
    for source in ("d1", "d3"):
        monkeypatch.setattr(catalog, source, lambda *a: Any())
    monkeypatch.setattr(catalog, "d1_matrix", lambda *a: (Any(), ["a"], None))
    monkeypatch.setattr(catalog, "d3_matrix", lambda *a: (Any(), Any(), ["a"], None))
    monkeypatch.setattr(catalog, "cut_lineage", lambda d: d)
    monkeypatch.setattr("quarry.operators.features.kfold", lambda *a: Any())
    with pytest.raises(Called) as e:
        query(None, None)
    return e.value.args[0]


@pytest.mark.parametrize(("query", "model"), [(catalog.q_svr_fits, "SVR"), (catalog.q_boosting_fits, "Gradient Boosting")])
def test_whole_grids(monkeypatch, query, model):
    assert list(call(monkeypatch, models, "benchmark", query)["models"]) == [model]


def test_rfecv_defaults(monkeypatch):
    got = call(monkeypatch, selection, "rfecv", catalog.q_rfecv)
    assert (got["num_trees"], got["max_depth"]) == (100, 12)


def test_all_noise_draws(monkeypatch):
    monkeypatch.setattr("quarry.operators.features.label_encode", lambda *a: None)
    assert call(monkeypatch, mi_knn, "mutual_information_knn", catalog.q_mi_knn)["runs"] == C.N_MI_RUNS


def test_all_models(monkeypatch):
    got = call(monkeypatch, pipeline, "model_sweep_kfold", catalog.q_model_sweep)
    assert list(got["models"]) == C.SPARK_MODEL_NAMES
    got = call(monkeypatch, pipeline, "run_pipeline", catalog.q_run_pipeline)
    assert list(got["models"] or got["cfg"].models) == C.SPARK_MODEL_NAMES
