import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from trajlake.session import get_session
    # one machine: a scratch folder is shared
    s = get_session(cpus="*", shuffle_partitions=8, checkpoint=str(tmp_path_factory.mktemp("checkpoints")))
    from trajlake.streaming.operators import state_store
    state_store(s)
    yield s
