"""The entry point has to import anywhere: without a session and without reading any installation."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import builtins, glob, os, zipfile
import pyspark.sql, pyspark.ml, pyspark.ml.fpm, pyspark.ml.feature, pyspark.ml.classification, pyspark.mllib.linalg.distributed

def refused(*a, **k):
    raise AssertionError("files are read at import")

glob.glob = glob.iglob = os.listdir = zipfile.ZipFile = refused
import __spark_entry__ as entry
from pyspark.sql import SparkSession
names, sql = entry.queries(), entry.oracle_sql()
assert set(sql) <= set(names) and len(sql) >= 40
assert SparkSession.getActiveSession() is None
"""


def test_import_needs_no_session_and_no_installation_files():
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, check=True)


def test_base_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    from opinia.functions.stop_words import base_stop_words

    assert sorted(base_stop_words()) == sorted(StopWordsRemover.loadDefaultStopWords("italian"))
