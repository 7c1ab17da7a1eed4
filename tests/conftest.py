import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabloom.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="tabloom-tests", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g",
                         "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tabloom-test-ckpt-")})
    checkpoint_dir(s)
    yield s
    s.stop()
