"""Keys do not appear in plans."""

import contextlib
import io

import pytest

from shillingflow.functions import security as S

KEY, SECRET = "Qk7Zp2Lm9Xv4Tb1R", "a-very-secret-signing-word"


def shown(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        for mode in ("simple", "extended", "formatted", "cost", "codegen"):
            df.explain(mode)
    return out.getvalue() + df._jdf.queryExecution().toString()


def leaks(text: str, secret: bytes) -> bool:
    return any(x.lower() in text.lower() for x in (secret.decode("latin-1"), secret.hex(), ", ".join(map(str, secret)), ",".join(map(str, secret))))


@pytest.mark.parametrize("saved", [False, True])
def test_plans_hide_keys(spark, tmp_path, saved):
    df = spark.createDataFrame([("0712345678", "x")], "phone string, sig string")
    if saved:
        df.write.parquet(str(tmp_path / "t"))
        df = spark.read.parquet(str(tmp_path / "t"))
    sealed = df.select(S.encrypt_field("phone", KEY).alias("c"), S.signature_status("phone", "sig", SECRET).alias("s"))
    opened = sealed.select(S.decrypt_field("c", KEY).alias("phone"), "s").filter("phone IS NOT NULL AND s = 'invalid'")
    assert [tuple(r) for r in opened.collect()] == [("0712345678", "invalid")]
    text = shown(opened)
    assert "redacted" in text
    assert not leaks(text, KEY.encode())
    for pad in S._pads(SECRET):
        assert not leaks(text, pad) and not leaks(text, pad[:26])


def test_own_setting_is_kept(spark):
    name, pattern = S.PLAN_REDACTION
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "mine-[0-9]+")
        S.hide_keys()
        S.hide_keys()
        assert spark.conf.get(name) == f"mine-[0-9]+|{pattern}"
    finally:
        spark.conf.set(name, before)
