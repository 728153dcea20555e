"""The session obeys the launcher; checked in a process of its own."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, args, **env):
    full = os.environ | {"PYTHONPATH": REPO, "PYSPARK_SUBMIT_ARGS": args + " pyspark-shell"} | env
    full.pop("SPARK_LOCAL_DIRS", None)
    return subprocess.run([sys.executable, "-c", code], env=full, cwd=REPO, capture_output=True, text=True, timeout=300)


SHOW = ("from strata.session import get_session; s = get_session(); "
        "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), "
        "s.conf.get('spark.sql.adaptive.skewJoin.skewedPartitionFactor'), s.conf.get('spark.sql.session.timeZone'))")


def test_master_and_partitions_of_the_launcher_stay():
    out = run(SHOW, "--master local[2] --conf spark.sql.shuffle.partitions=2000 "
                    "--conf spark.sql.adaptive.skewJoin.skewedPartitionFactor=7 --conf spark.ui.enabled=false")
    assert out.stdout.split()[-4:] == ["local[2]", "2000", "7", "UTC"] or out.stdout.split()[-4:-1] == ["local[2]", "2000", "7"], out.stderr


def test_open_settings_are_filled_in():
    out = run(SHOW, "--master local[3] --conf spark.ui.enabled=false")
    assert out.stdout.split()[-4:-2] == ["local[3]", "3"], out.stderr


def test_an_unset_shared_folder_is_an_error_beyond_one_machine(tmp_path):
    code = ("import strata.session as m\n"
            "s = m.get_session()\n"
            "m.is_one_machine = lambda spark: False\n"
            "m.shared_dir(s, 'x')")
    out = run(code, "--master local[1] --conf spark.ui.enabled=false", SPARK_CONF_DIR=str(tmp_path))
    assert out.returncode and "must name a shared folder" in out.stderr


def test_command_line_sizes_shuffles_from_the_input():
    code = ("import strata.session as m, strata.__main__ as c\n"
            "from strata.plans import gold\n"
            "m.is_one_machine = lambda spark: False\n"
            "gold.build = lambda spark, sf, wh: {'partitions': spark.conf.get('spark.sql.shuffle.partitions')}\n"
            "c.main(['gold', '--sf', 'x', '--warehouse', 'y', '--input-gb', '1024'])")
    out = run(code, "--master local[1] --conf spark.ui.enabled=false")
    assert '"partitions": "4096"' in out.stdout, out.stderr
