"""The sales mart: every transaction with its customer, its product, and what it earned."""

from tidemark.plans.specs import Model

# The columns of the mart, and what revenue, cost and margin are made of. The products are
# joined first, while the rows are narrow; the customers come last, when nothing is computed from them.
SALES_MART_SQL = """
WITH sold AS (
    SELECT txn_id, to_date(txn_ts) AS txn_date, customer_id, product_sku, quantity, amount AS revenue
    FROM transactions
), costed AS (
    SELECT sold.*, products.product_name, products.category, sold.quantity * products.unit_cost AS full_cost
    FROM sold JOIN products ON sold.product_sku = products.product_sku
)
SELECT costed.txn_id, costed.txn_date,
       customers.customer_id, customers.name AS customer_name, customers.region,
       costed.product_sku, costed.product_name, costed.category,
       costed.quantity, costed.revenue,
       round(full_cost, 2) AS cost, round(revenue - full_cost, 2) AS gross_margin
FROM costed JOIN customers ON costed.customer_id = customers.customer_id
"""

SALES_MART = Model(
    name="sales_mart",
    inputs=("customers", "transactions", "products"),
    sql=SALES_MART_SQL,
    table="sales_mart",
    money_columns=("revenue", "cost", "gross_margin"),
)
