import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ratelake.session import local_session, work_path  # noqa: E402
from ratelake.sinks.store import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def store(spark):
    made = TableStore(spark, f"t_{uuid.uuid4().hex[:10]}", work_path(spark, "db"))
    made.ensure_database()
    return made


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, so that order does not matter."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def landing(spark, tmp_path):
    """Write landing files: ``add(series, month, xml text)``; ``root`` is the folder."""

    class Landing:
        root = str(tmp_path / "landing")

        def add(self, series, month, xml, name="part.xml"):
            folder = Path(self.root) / f"series={series}" / f"month={month}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_text(xml)

        def observations(self, series, month, *pairs, name="part.xml"):
            body = "".join(
                "<Obs>" + (f"<Fecha>{d}</Fecha>" if d is not None else "") + (f"<Valor>{v}</Valor>" if v is not None else "") + "</Obs>"
                for d, v in pairs
            )
            self.add(series, month, f"<ObservacionesSeries>{body}</ObservacionesSeries>", name)

    return Landing()
