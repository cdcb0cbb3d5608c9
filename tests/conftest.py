import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from funil import SalesTables, schema as S  # noqa: E402
from funil.settings import local_session  # noqa: E402
from helpers import T0, T1, T2  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", "8", "4g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    """Rows chosen for their edge cases: NULL and empty tags, a NULL within tags,
    a JSON null, missing and repeated keys, no settings, a provider without
    leads, a lead without messages, equal times, one contact at two providers."""
    provedores = [
        (1, "Alfa", "alfa_w", "k1", '{"modelo":"m1","max_tokens":500,"temperatura":0.70,"prompt_sdr":"São"}',
         "basico", True, T0, T0),
        (2, "Beta", "beta_w", "k2", '{"modelo":null,"prompt_sdr":null}', "profissional", True, T0, T0),
        (3, "Gama", "gama_w", "k3", None, "enterprise", False, T0, T0),
        (4, "Delta", "delta_w", "k4", '{"modelo":"old","modelo":"m1"}', "basico", True, T0, T0),
    ]
    planos = [
        (1, "Quartzo", "75 Mbps", Decimal("64.25"), 1, True, T0, T0),
        (2, "Safira", "640 Mbps", Decimal("188.75"), 1, True, T0, T0),
        (3, "Antigo", "10 Mbps", Decimal("19.90"), 1, False, T0, T0),
        (4, "Só inativo", "5 Mbps", Decimal("9.90"), 2, False, T0, T0),
    ]
    leads = [
        (1, "Ana", "1", "Rua A", "c1", "w1", ["lead_quente", "residencial"], T0, T0, 1),
        (2, None, None, None, "c2", None, None, T1, T1, 1),
        (3, "Bia", None, "Rua B", "c3", None, [], T1, T1, 1),
        (4, "Caio", None, "Av C", "c1", None, ["lead_morno", None], T2, T2, 2),
        (5, "Davi", None, None, "c5", None, ["lead_frio"], T2, T2, 3),
    ]
    mensagens = [
        (1, "oi", False, T0, 1),
        (3, "tudo bem?", True, T1, 1),
        (2, "olá", True, T1, 1),
        (4, "preço", False, T2, 1),
        (5, "bom dia", False, T0, 4),
        (6, "boa tarde", True, T2, 5),
    ]
    rows = {"provedores": provedores, "planos": planos, "leads": leads, "mensagens": mensagens}
    return SalesTables(**{
        name: spark.createDataFrame(values, S.SCHEMAS[name]) for name, values in rows.items()
    })
