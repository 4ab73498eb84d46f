import pytest
from conftest import lines_df

from sparkloom.operators import lines

SESSION_HEADER = "sessionid,userid,username,videoid,duration,starttime,sex"


def test_skip_prefix_drops_every_matching_line(spark):
    src = lines_df(spark, [SESSION_HEADER, "1,2,bob,4,5,6,1", "SessionId,repeated header", "3,4,amy,5,6,7,2"])
    assert [r.value for r in lines.skip_prefix(src, "sessionid").collect()] == ["1,2,bob,4,5,6,1", "3,4,amy,5,6,7,2"]


def test_recode_and_keep_seven_fields(spark):
    src = lines_df(spark, ["1,2,bob,4,5,6,1,extra", "1,2,amy,4,5,6,2", "1,2,x,4,5,6,3"])
    out = [r.value for r in lines.recode_field(src).collect()]
    assert out == ["1,2,bob,4,5,6,M", "1,2,amy,4,5,6,F", "1,2,x,4,5,6,3"]
    with pytest.raises(Exception):  # trailing empty field is dropped by split -> only 6 fields
        lines.recode_field(lines_df(spark, ["1,2,y,4,5,6,"])).collect()


def test_field_upper(spark):
    assert [r.value for r in lines.field_upper(lines_df(spark, ["1,2,bob,x"]), 2).collect()] == ["BOB"]


def test_field_equals(spark):
    header = "id,name,last name,city"
    src = lines_df(spark, ["ID,Name,Last Name,City", "1,a,b,Los Angeles", "2,c,d,los angeles", "3,e,f,Los Angeles ",
                           "4,g,h,Boston"])
    got = [r.value for r in lines.field_equals(src, header, 3, "Los Angeles").collect()]
    assert got == ["1,a,b,Los Angeles"]
    with pytest.raises(Exception):
        lines.field_equals(lines_df(spark, ["1,a"]), header, 3, "x").collect()


def test_id_prefix(spark):
    src = lines_df(spark, ["#CT1 comment", "CT1,a", "CT10,b", "CT2,c", "xCT1"])
    assert [r.value for r in lines.id_prefix(src, "CT1").collect()] == ["CT1,a", "CT10,b"]


def test_project(spark):
    df = spark.createDataFrame([("1001", "Quill"), ("1002", "Bramble")], "id string, name string")
    assert [r.name for r in lines.project(df, "name").collect()] == ["Quill", "Bramble"]
