import pytest

pytest.importorskip("skyloom.llm")
