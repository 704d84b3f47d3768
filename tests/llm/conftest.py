from llm.conftest_llm import docs_of, none, odd, workers  # noqa: F401
