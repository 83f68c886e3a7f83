"""Rows of known raw files and what has to become of them."""

import pytest

from retail_lens.plans import cleaning
from retail_lens.sources.files import scan_csv_text, write_csv

# Excerpts of raw files and of their clean counterparts.
GOLDENS = {
    "products": (
        cleaning.clean_products,
        """sku,product_name,category,list_price,unit_cost,pack_size
SKU001,Pure Spring Water 500ml (12-pack),Beverages,GHS 18.00,12.5,12
SKU004,Energy Drink 250ml (24-pack),Beverages,110.0,80.0,24
sku008,Tomato Paste 400g (12-tin),FOOD,66.0,48.0,12
""",
        """sku,product_name,category,list_price,unit_cost,pack_size
SKU001,Pure Spring Water 500ml (12-pack),Beverages,18.0,12.5,12
SKU004,Energy Drink 250ml (24-pack),Beverages,110.0,80.0,24
SKU008,Tomato Paste 400g (12-tin),Food,66.0,48.0,12
""",
    ),
    "customers": (
        cleaning.clean_customers,
        """customer_id,outlet_name,region,channel,rep_id
C001,NANA'S KIOSK 1,Western,Super Market,R07
C004,Grace Depot 4,Western Region,Supermarket,R08
C008,Nana's Wholesale 8,Ashanti,Retail Shop,R04
""",
        """customer_id,outlet_name,region,channel,rep_id
C001,Nana'S Kiosk 1,Western,Supermarket,R07
C004,Grace Depot 4,Western,Supermarket,R08
C008,Nana'S Wholesale 8,Ashanti,Retail Shop,R04
""",
    ),
    "reps": (
        cleaning.clean_reps,
        """rep_id,rep_name,region,hire_date
R01,KWAME MENSAH,Greater Accra,2019-10-11
R04,Akosua Owusu,ashanti region,2020-02-12
R08,Efua Quaye,Western,2021-02-14
""",
        """rep_id,rep_name,region,hire_date
R01,Kwame Mensah,Greater Accra,2019-10-11
R04,Akosua Owusu,Ashanti,2020-02-12
R08,Efua Quaye,Western,2021-02-14
""",
    ),
    "targets": (
        cleaning.clean_targets,
        """rep_id,month,target_amount
R01,Jan-2025,"109,760"
R01,Apr-2025,"109,640"
R01,Aug-2025,"82,630"
""",
        """rep_id,target_amount,month_start
R01,109760.0,2025-01-01
R01,109640.0,2025-04-01
R01,82630.0,2025-08-01
""",
    ),
}


@pytest.mark.parametrize("name", GOLDENS)
def test_clean_rows(spark, tmp_path, name):
    clean, raw, want = GOLDENS[name]
    (tmp_path / "raw.csv").write_text(raw)
    df = clean(scan_csv_text(spark, str(tmp_path / "raw.csv"), raw.split("\n")[0].split(",")))
    write_csv(df.orderBy(*[c for c in df.columns if c in ("sku", "customer_id", "rep_id", "month_start")]), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == want
