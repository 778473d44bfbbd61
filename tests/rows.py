"""Small landing files with known results.

Fixed values: the rows below belong to the expected results in the golden tests.
"""

SEEDS = {
    "raw_customers.csv": """\
customer_id,first_name,last_name,email,country,created_at
1,Alice,Martin,alice.martin@example.com,US,2024-01-05
2,Bob,Chen,bob.chen@example.com,CA,2024-01-12
3,Clara,Nguyen,clara.nguyen@example.com,US,2024-02-03
4,David,Patel,david.patel@example.com,GB,2024-02-14
5,Eva,Schmidt,eva.schmidt@example.com,DE,2024-03-01
6,Frank,Rossi,frank.rossi@example.com,IT,2024-03-18
7,Grace,Kim,grace.kim@example.com,KR,2024-04-07
8,Henry,Okafor,henry.okafor@example.com,NG,2024-04-22
9,Iris,Tanaka,iris.tanaka@example.com,JP,2024-05-10
10,Jack,Oliveira,jack.oliveira@example.com,BR,2024-05-30
""",
    "raw_orders.csv": """\
order_id,customer_id,order_date,status,amount
101,1,2024-02-10,completed,120.50
102,1,2024-03-15,completed,89.99
103,2,2024-02-20,completed,250.00
104,3,2024-03-05,shipped,45.00
105,3,2024-04-01,completed,310.75
106,4,2024-03-20,cancelled,60.00
107,5,2024-04-10,completed,180.00
108,6,2024-04-18,pending,95.25
109,7,2024-05-02,completed,430.00
110,7,2024-05-15,completed,77.50
111,8,2024-05-20,shipped,200.00
112,9,2024-05-25,completed,55.00
113,10,2024-06-01,pending,320.00
114,2,2024-06-05,completed,140.00
115,4,2024-06-10,completed,88.00
""",
}

MARKETPLACE = {
    "olist_customers_dataset.csv": """\
customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
cust_id_1,cust_unique_1,01001,sao paulo,SP
cust_id_2,cust_unique_1,01001,sao paulo,SP
cust_id_3,cust_unique_2,20040,rio de janeiro,RJ
cust_id_4,cust_unique_3,30140,belo horizonte,MG
cust_id_5,cust_unique_4,40010,salvador,BA
""",
    "olist_orders_dataset.csv": """\
order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
order_1,cust_id_1,delivered,2024-01-05 10:00:00,2024-01-05 11:00:00,2024-01-06 09:00:00,2024-01-10 14:00:00,2024-01-15 00:00:00
order_2,cust_id_3,delivered,2024-01-08 09:30:00,2024-01-08 10:00:00,2024-01-09 08:00:00,2024-01-12 16:00:00,2024-01-18 00:00:00
order_3,cust_id_2,delivered,2024-02-01 12:00:00,2024-02-01 12:30:00,2024-02-02 10:00:00,2024-02-06 13:00:00,2024-02-12 00:00:00
order_4,cust_id_4,shipped,2024-02-10 15:00:00,2024-02-10 15:30:00,2024-02-11 09:00:00,,2024-02-20 00:00:00
order_5,cust_id_5,canceled,2024-02-15 08:00:00,,,,2024-02-25 00:00:00
""",
    "olist_order_items_dataset.csv": """\
order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
order_1,1,prod_1,seller_1,2024-01-06 00:00:00,150.00,15.00
order_2,1,prod_2,seller_2,2024-01-09 00:00:00,80.00,10.00
order_3,1,prod_1,seller_1,2024-02-02 00:00:00,200.00,20.00
order_4,1,prod_3,seller_2,2024-02-11 00:00:00,50.00,8.00
order_5,1,prod_2,seller_1,2024-02-16 00:00:00,60.00,9.00
""",
    "olist_order_payments_dataset.csv": """\
order_id,payment_sequential,payment_type,payment_installments,payment_value
order_1,1,credit_card,3,165.00
order_2,1,boleto,1,90.00
order_3,1,credit_card,2,220.00
order_4,1,voucher,1,58.00
order_5,1,credit_card,1,69.00
""",
    "olist_order_reviews_dataset.csv": """\
review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
rev_1,order_1,5,great,fast delivery,2024-01-11 00:00:00,2024-01-12 00:00:00
rev_2,order_2,4,good,as expected,2024-01-13 00:00:00,2024-01-14 00:00:00
rev_3,order_3,5,excellent,will buy again,2024-02-07 00:00:00,2024-02-08 00:00:00
rev_4,order_4,3,ok,a bit slow,2024-02-19 00:00:00,2024-02-20 00:00:00
rev_5,order_5,1,bad,order was canceled,2024-02-26 00:00:00,2024-02-27 00:00:00
""",
    "olist_products_dataset.csv": """\
product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
prod_1,informatica_acessorios,45,200,2,500,20,10,15
prod_2,beleza_saude,38,150,1,300,15,8,12
prod_3,cama_mesa_banho,50,180,3,1200,40,20,30
""",
    "olist_sellers_dataset.csv": """\
seller_id,seller_zip_code_prefix,seller_city,seller_state
seller_1,04001,sao paulo,SP
seller_2,01310,sao paulo,SP
""",
    "olist_geolocation_dataset.csv": """\
geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01001,-23.550,-46.633,sao paulo,SP
01001,-23.551,-46.634,sao paulo,SP
20040,-22.906,-43.172,rio de janeiro,RJ
30140,-19.917,-43.934,belo horizonte,MG
40010,-12.971,-38.501,salvador,BA
04001,-23.561,-46.652,sao paulo,SP
01310,-23.561,-46.656,sao paulo,SP
""",
    "product_category_name_translation.csv": """\
product_category_name,product_category_name_english
informatica_acessorios,computers_accessories
beleza_saude,health_beauty
cama_mesa_banho,bed_bath_table
""",
}
