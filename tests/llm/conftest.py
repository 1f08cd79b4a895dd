import pytest


@pytest.fixture(scope="session")
def queries():
    from hazardlens.llm import registry
    return registry.queries()
