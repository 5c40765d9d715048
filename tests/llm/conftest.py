import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(tmp_path_factory):
    """A folder for written tables, where the session names none."""
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("shared")
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(folder))
    return folder
