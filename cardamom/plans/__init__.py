"""Business questions as lazy plans over canonical tables.

Canonical columns: transactions (transaction_id, business_id, card_id,
user_id, timestamp, amount, declined, product_ids, lat, longitude), companies
(company_id, company_name, phone, country), users (user_id, name, surname,
email), products (product_id, name, price, colour).
"""
