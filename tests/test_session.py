import zipfile

from fundlake.session import ship_package


def test_the_package_is_shipped_to_executors(spark, tmp_path):
    archive = ship_package(spark, str(tmp_path))
    names = zipfile.ZipFile(archive).namelist()
    assert "fundlake/session.py" in names and "fundlake/operators/scan.py" in names
    assert any(str(path).endswith("fundlake.zip") for path in spark.sparkContext.listFiles)
