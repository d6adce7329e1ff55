import datetime as dt

from clickflow import schemas

T0 = dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=dt.timezone.utc)


def action(event_id, session="s1", page=1, secs=0, click=-1, orders=None, pays=None, date=None, t0=T0):
    t = t0 + dt.timedelta(seconds=secs)
    return dict(event_id=event_id, date=date or t.strftime("%Y-%m-%d"), user_id=1, session_id=session,
                page_id=page, action_time=t, search_keyword=None, click_category_id=click,
                click_product_id=-1, order_category_ids=orders, order_product_ids=None,
                pay_category_ids=pays, pay_product_ids=None, city_id=1)


def actions_df(spark, rows):
    cols = schemas.VISIT_ACTION_COLUMNS
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schemas.VISIT_ACTION)


def ad_row(event_id, t, userid="1", adid="1", area="A", city="C"):
    ms = int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return (event_id, t, ms, t.strftime("%Y-%m-%d"), area, city, userid, adid)


def ad_df(spark, rows):
    return spark.createDataFrame(rows, schemas.AD_LOG)
