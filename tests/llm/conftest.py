import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """frame(schema, rows) -> DataFrame over several partitions."""

    def make(schema, rows, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def vocab_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
