"""The reference's bundled sample rows (10 orders, 5 customers,
6 products), in their original file shapes, and goldens computed from them."""

from decimal import Decimal

ORDERS_CSV = """order_id,customer_id,product_id,order_date,quantity,unit_price,discount
1,101,201,2024-01-15,2,29.99,0.00
2,102,202,2024-01-15,1,49.99,5.00
3,101,203,2024-01-16,3,19.99,0.00
4,103,201,2024-01-16,1,29.99,0.00
5,102,204,2024-01-17,2,39.99,10.00
6,104,202,2024-01-17,1,49.99,0.00
7,101,205,2024-01-18,4,15.99,0.00
8,103,203,2024-01-18,2,19.99,0.00
9,105,201,2024-01-19,1,29.99,0.00
10,102,206,2024-01-19,3,24.99,0.00
"""

CUSTOMERS_JSON = """[
  {"customer_id": 101, "customer_name": "Nguyễn Văn A", "email": "nguyenvana@example.com",
   "city": "Hà Nội", "country": "Việt Nam"},
  {"customer_id": 102, "customer_name": "Trần Thị B", "email": "tranthib@example.com",
   "city": "Hồ Chí Minh", "country": "Việt Nam"},
  {"customer_id": 103, "customer_name": "Lê Văn C", "email": "levanc@example.com",
   "city": "Đà Nẵng", "country": "Việt Nam"},
  {"customer_id": 104, "customer_name": "Phạm Thị D", "email": "phamthid@example.com",
   "city": "Hà Nội", "country": "Việt Nam"},
  {"customer_id": 105, "customer_name": "Hoàng Văn E", "email": "hoangvane@example.com",
   "city": "Hồ Chí Minh", "country": "Việt Nam"}
]
"""

PRODUCTS_JSON = """{
  "products": [
    {"product_id": 201, "product_name": "Laptop Dell XPS 13", "category": "Electronics", "brand": "Dell", "price": 29.99},
    {"product_id": 202, "product_name": "iPhone 15 Pro", "category": "Electronics", "brand": "Apple", "price": 49.99},
    {"product_id": 203, "product_name": "Wireless Mouse", "category": "Accessories", "brand": "Logitech", "price": 19.99},
    {"product_id": 204, "product_name": "Mechanical Keyboard", "category": "Accessories", "brand": "Corsair", "price": 39.99},
    {"product_id": 205, "product_name": "USB-C Cable", "category": "Accessories", "brand": "Anker", "price": 15.99},
    {"product_id": 206, "product_name": "Monitor 27 inch", "category": "Electronics", "brand": "LG", "price": 24.99}
  ]
}
"""

ORDERS_SCHEMA = ("order_id BIGINT, customer_id BIGINT, product_id BIGINT, order_date DATE, quantity INT, "
                 "unit_price DECIMAL(10,2), discount DECIMAL(5,2)")

# (order_id, total_amount, discount_amount, final_amount)
X1_GOLDEN = [
    (1, Decimal("59.98"), Decimal("0"), Decimal("59.98")),
    (2, Decimal("49.99"), Decimal("2.4995"), Decimal("47.4905")),
    (3, Decimal("59.97"), Decimal("0"), Decimal("59.97")),
    (4, Decimal("29.99"), Decimal("0"), Decimal("29.99")),
    (5, Decimal("79.98"), Decimal("7.998"), Decimal("71.982")),
    (6, Decimal("49.99"), Decimal("0"), Decimal("49.99")),
    (7, Decimal("63.96"), Decimal("0"), Decimal("63.96")),
    (8, Decimal("39.98"), Decimal("0"), Decimal("39.98")),
    (9, Decimal("29.99"), Decimal("0"), Decimal("29.99")),
    (10, Decimal("74.97"), Decimal("0"), Decimal("74.97")),
]
X1_SUMS = (Decimal("538.80"), Decimal("10.4975"), Decimal("528.3025"))

# date, quantity_sum, total_amount_sum, final_amount_sum, order_count
DAILY_GOLDEN = [
    ("2024-01-15", 3, Decimal("109.97"), Decimal("107.4705"), 2),
    ("2024-01-16", 4, Decimal("89.96"), Decimal("89.96"), 2),
    ("2024-01-17", 3, Decimal("129.97"), Decimal("121.972"), 2),
    ("2024-01-18", 6, Decimal("103.94"), Decimal("103.94"), 2),
    ("2024-01-19", 4, Decimal("104.96"), Decimal("104.96"), 2),
]
# customer_id -> (revenue, orders), in revenue order
TOP_CUSTOMERS = [(102, 204.94, 3), (101, 183.91, 3), (103, 69.97, 2), (104, 49.99, 1), (105, 29.99, 1)]
# category -> (revenue, rows, quantity)
CATEGORIES = {"Electronics": (294.91, 6, 9), "Accessories": (243.89, 4, 11)}
