"""The reference's sample rows, typed as Spark DataFrames, plus invented fixtures.

The first block holds fixed values: the rows of the reference's sample data
(dates, channels, customers with one SCD2 history row, products, orders),
in their original order.  Items and events have no sample rows in the
reference; ``invented_items`` and ``invented_events`` are our own fixtures,
labelled as such, built to exercise the cases listed in FIXTURES.md.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- fixed values: reference sample rows ----------------------------------
# dim_date: date_key, full_date, year, quarter, month, month_name,
#           week_of_year, day_of_week (0 = Sunday), day_name, is_weekend, is_holiday
DIM_DATE_ROWS = [
    (20240101,'2024-01-01',2024,1,1,'January',1,1,'Monday',False,True),
    (20240105,'2024-01-05',2024,1,1,'January',1,5,'Friday',False,False),
    (20240108,'2024-01-08',2024,1,1,'January',2,1,'Monday',False,False),
    (20240112,'2024-01-12',2024,1,1,'January',2,5,'Friday',False,False),
    (20240115,'2024-01-15',2024,1,1,'January',3,1,'Monday',False,False),
    (20240120,'2024-01-20',2024,1,1,'January',3,6,'Saturday',True,False),
    (20240125,'2024-01-25',2024,1,1,'January',4,4,'Thursday',False,False),
    (20240201,'2024-02-01',2024,1,2,'February',5,4,'Thursday',False,False),
    (20240205,'2024-02-05',2024,1,2,'February',6,1,'Monday',False,False),
    (20240210,'2024-02-10',2024,1,2,'February',6,6,'Saturday',True,False),
    (20240214,'2024-02-14',2024,1,2,'February',7,3,'Wednesday',False,False),
    (20240220,'2024-02-20',2024,1,2,'February',8,2,'Tuesday',False,False),
    (20240225,'2024-02-25',2024,1,2,'February',8,0,'Sunday',True,False),
    (20240301,'2024-03-01',2024,1,3,'March',9,5,'Friday',False,False),
    (20240305,'2024-03-05',2024,1,3,'March',10,2,'Tuesday',False,False),
    (20240310,'2024-03-10',2024,1,3,'March',10,0,'Sunday',True,False),
    (20240315,'2024-03-15',2024,1,3,'March',11,5,'Friday',False,False),
    (20240320,'2024-03-20',2024,1,3,'March',12,3,'Wednesday',False,False),
    (20240325,'2024-03-25',2024,1,3,'March',13,1,'Monday',False,False),
    (20240401,'2024-04-01',2024,2,4,'April',14,1,'Monday',False,False),
    (20240405,'2024-04-05',2024,2,4,'April',14,5,'Friday',False,False),
    (20240410,'2024-04-10',2024,2,4,'April',15,3,'Wednesday',False,False),
    (20240415,'2024-04-15',2024,2,4,'April',16,1,'Monday',False,False),
    (20240420,'2024-04-20',2024,2,4,'April',16,6,'Saturday',True,False),
    (20240425,'2024-04-25',2024,2,4,'April',17,4,'Thursday',False,False),
    (20240501,'2024-05-01',2024,2,5,'May',18,3,'Wednesday',False,False),
    (20240505,'2024-05-05',2024,2,5,'May',18,0,'Sunday',True,False),
    (20240510,'2024-05-10',2024,2,5,'May',19,5,'Friday',False,False),
    (20240515,'2024-05-15',2024,2,5,'May',20,3,'Wednesday',False,False),
    (20240520,'2024-05-20',2024,2,5,'May',21,1,'Monday',False,False),
    (20240525,'2024-05-25',2024,2,5,'May',21,6,'Saturday',True,False),
    (20240601,'2024-06-01',2024,2,6,'June',22,6,'Saturday',True,False),
    (20240605,'2024-06-05',2024,2,6,'June',23,3,'Wednesday',False,False),
    (20240610,'2024-06-10',2024,2,6,'June',24,1,'Monday',False,False),
    (20240615,'2024-06-15',2024,2,6,'June',24,6,'Saturday',True,False),
    (20240620,'2024-06-20',2024,2,6,'June',25,4,'Thursday',False,False),
    (20240625,'2024-06-25',2024,2,6,'June',26,2,'Tuesday',False,False),
]

# dim_channel: channel_key, channel_name, channel_type
DIM_CHANNEL_ROWS = [
    (1,'organic_search','organic'),
    (2,'paid_search','paid'),
    (3,'social_media','paid'),
    (4,'email_campaign','owned'),
    (5,'mobile_app','owned'),
    (6,'referral','organic'),
]

# dim_customer: customer_key, customer_id, first_name, last_name, email, country, city,
#               age_band, acquisition_channel, effective_date, expiry_date, is_current
DIM_CUSTOMER_ROWS = [
    (1,'C001','Alice','Morgan','alice.morgan@email.com','USA','New York','25-34','organic','2024-01-05',None,True),
    (2,'C002','Bob','Chen','bob.chen@email.com','UK','London','35-44','paid_search','2024-01-08',None,True),
    (3,'C003','Carol','Santos','carol.santos@email.com','USA','Chicago','25-34','social','2024-01-10',None,True),
    (4,'C004','Dave','Patel','dave.patel@email.com','Canada','Toronto','45-54','organic','2024-01-12',None,True),
    (5,'C005','Eve','Kim','eve.kim@email.com','USA','Los Angeles','18-24','social','2024-01-15',None,True),
    (6,'C006','Frank','Liu','frank.liu@email.com','Australia','Sydney','35-44','referral','2024-01-20',None,True),
    (7,'C007','Grace','Osei','grace.osei@email.com','UK','Manchester','25-34','paid_search','2024-02-01',None,True),
    (8,'C008','Hank','Müller','hank.muller@email.com','Germany','Berlin','35-44','organic','2024-02-05',None,True),
    (9,'C009','Iris','Nakamura','iris.nakamura@email.com','Japan','Tokyo','25-34','social','2024-02-10',None,True),
    (10,'C010','Jack','Williams','jack.williams@email.com','USA','Houston','45-54','email','2024-02-14',None,True),
    (11,'C011','Kate','Brown','kate.brown@email.com','USA','Phoenix','18-24','organic','2024-02-20',None,True),
    (12,'C012','Leo','Fernandez','leo.fernandez@email.com','Brazil','São Paulo','25-34','referral','2024-02-25',None,True),
    (13,'C013','Mia','Johansson','mia.johansson@email.com','Sweden','Stockholm','35-44','paid_search','2024-03-01',None,True),
    (14,'C014','Noah','Garcia','noah.garcia@email.com','USA','San Antonio','25-34','organic','2024-03-05',None,True),
    (15,'C015','Olivia','Park','olivia.park@email.com','South Korea','Seoul','18-24','social','2024-03-10',None,True),
    (16,'C016','Pete','Ahmed','pete.ahmed@email.com','UAE','Dubai','45-54','paid_search','2024-03-15',None,True),
    (17,'C017','Quinn','Russo','quinn.russo@email.com','Italy','Milan','35-44','referral','2024-03-20',None,True),
    (18,'C018','Rosa','Dubois','rosa.dubois@email.com','France','Paris','25-34','email','2024-03-25',None,True),
    (19,'C019','Sam','Wilson','sam.wilson@email.com','USA','Philadelphia','35-44','organic','2024-04-01',None,True),
    (20,'C020','Tina','Nguyen','tina.nguyen@email.com','Vietnam','Hanoi','25-34','social','2024-04-05',None,True),
    (21,'C021','Uma','Svensson','uma.svensson@email.com','Sweden','Gothenburg','45-54','paid_search','2024-04-10',None,True),
    (22,'C022','Victor','Costa','victor.costa@email.com','Portugal','Lisbon','35-44','referral','2024-04-15',None,True),
    (23,'C023','Wendy','Zhang','wendy.zhang@email.com','China','Shanghai','25-34','paid_search','2024-04-20',None,True),
    (24,'C024','Xander','Ibrahim','xander.ibrahim@email.com','Egypt','Cairo','18-24','organic','2024-04-25',None,True),
    (25,'C025','Yara','Petrov','yara.petrov@email.com','Russia','Moscow','35-44','email','2024-05-01',None,True),
    (26,'C026','Zoe','Andersen','zoe.andersen@email.com','Denmark','Copenhagen','25-34','organic','2024-05-05',None,True),
    (27,'C027','Aaron','Singh','aaron.singh@email.com','India','Mumbai','25-34','social','2024-05-10',None,True),
    (28,'C028','Beth','Taylor','beth.taylor@email.com','UK','Birmingham','45-54','paid_search','2024-05-15',None,True),
    (29,'C029','Chris','Martin','chris.martin@email.com','USA','San Diego','18-24','referral','2024-05-20',None,True),
    (30,'C030','Diana','Kowalski','diana.kowalski@email.com','Poland','Warsaw','35-44','organic','2024-05-25',None,True),
    (31,'C031','Ethan','Rossi','ethan.rossi@email.com','Italy','Rome','25-34','paid_search','2024-06-01',None,True),
    (32,'C032','Fiona','Chang','fiona.chang@email.com','Taiwan','Taipei','25-34','social','2024-06-05',None,True),
    (33,'C033','George','Hassan','george.hassan@email.com','Morocco','Casablanca','35-44','organic','2024-06-10',None,True),
    (34,'C034','Hannah','Lee','hannah.lee@email.com','USA','Seattle','18-24','email','2024-06-15',None,True),
    (35,'C035','Ivan','Popescu','ivan.popescu@email.com','Romania','Bucharest','45-54','referral','2024-06-20',None,True),
    (36,'C036','Julia','Yamamoto','julia.yamamoto@email.com','Japan','Osaka','25-34','organic','2024-06-25',None,True),
    (101,'C001','Alice','Morgan','alice.morgan@email.com','USA','New York','25-34','organic','2024-01-05','2024-04-01',False),
]

# dim_product: product_key, product_id, product_name, category, subcategory, brand,
#              cost_price, list_price, is_active
DIM_PRODUCT_ROWS = [
    (1,'P001','MacBook Pro 14"','Electronics','Laptops','Apple',1200,1799,True),
    (2,'P002','Sony WH-1000XM5','Electronics','Headphones','Sony',150,349,True),
    (3,'P003','iPhone 15','Electronics','Phones','Apple',650,999,True),
    (4,'P004','Samsung 4K TV 55"','Electronics','TVs','Samsung',400,799,True),
    (5,'P005','Levi 501 Jeans','Clothing','Bottoms','Levi',35,89,True),
    (6,'P006','Nike Air Max 270','Clothing','Shoes','Nike',75,150,True),
    (7,'P007','Patagonia Fleece','Clothing','Tops','Patagonia',80,179,True),
    (8,'P008','Instant Pot 7-in-1','Home','Kitchen','Instant Pot',60,99,True),
    (9,'P009','Dyson V15 Vacuum','Home','Cleaning','Dyson',250,599,True),
    (10,'P010','LEGO Technic Set','Toys','Building','LEGO',45,89,True),
    (11,'P011','Atomic Habits','Books','Non-Fiction','Penguin',8,18,True),
    (12,'P012','Yoga Mat Pro','Sports','Yoga','Manduka',40,88,True),
    (13,'P013','Kindle Paperwhite','Electronics','E-Readers','Amazon',80,139,True),
    (14,'P014','Air Fryer XL','Home','Kitchen','Ninja',50,109,True),
    (15,'P015','Running Shoes GT','Sports','Running','Asics',70,140,True),
]

# fact_orders: order_key, order_id, date_key, customer_key, channel_key, order_status,
#              item_count, gross_revenue, discount_amount, net_revenue, shipping_cost,
#              is_first_order
FACT_ORDER_ROWS = [
    (1,'ORD-001',20240105,1,1,'completed',2,349.00,34.90,314.10,9.99,True),
    (2,'ORD-002',20240108,2,2,'completed',1,1799.00,0,1799.00,0,True),
    (3,'ORD-003',20240112,3,3,'completed',3,356.00,35.60,320.40,9.99,True),
    (4,'ORD-004',20240115,4,1,'completed',1,99.00,0,99.00,5.99,True),
    (5,'ORD-005',20240120,5,3,'completed',2,239.00,23.90,215.10,9.99,True),
    (6,'ORD-006',20240125,6,6,'completed',1,18.00,0,18.00,3.99,True),
    (7,'ORD-007',20240201,1,4,'completed',1,139.00,0,139.00,0,False),
    (8,'ORD-008',20240205,2,2,'completed',2,438.00,43.80,394.20,0,False),
    (9,'ORD-009',20240210,3,1,'completed',1,150.00,15.00,135.00,5.99,False),
    (10,'ORD-010',20240214,5,3,'refunded',1,88.00,0,88.00,0,False),
    (11,'ORD-011',20240301,1,4,'completed',2,207.00,20.70,186.30,0,False),
    (12,'ORD-012',20240305,2,2,'completed',1,599.00,59.90,539.10,0,False),
    (13,'ORD-013',20240315,3,1,'completed',3,447.00,44.70,402.30,9.99,False),
    (14,'ORD-014',20240401,1,4,'completed',1,799.00,79.90,719.10,0,False),
    (15,'ORD-015',20240410,2,2,'cancelled',2,698.00,0,698.00,0,False),
    (16,'ORD-016',20240501,1,4,'completed',1,109.00,10.90,98.10,0,False),
    (17,'ORD-017',20240510,3,1,'completed',2,280.00,28.00,252.00,9.99,False),
    (18,'ORD-018',20240201,7,2,'completed',2,349.00,0,349.00,9.99,True),
    (19,'ORD-019',20240205,8,1,'completed',1,999.00,99.90,899.10,0,True),
    (20,'ORD-020',20240210,9,3,'completed',2,178.00,17.80,160.20,5.99,True),
    (21,'ORD-021',20240214,10,4,'completed',1,89.00,0,89.00,3.99,True),
    (22,'ORD-022',20240220,11,3,'completed',3,447.00,44.70,402.30,9.99,True),
    (23,'ORD-023',20240225,12,6,'completed',1,150.00,0,150.00,5.99,True),
    (24,'ORD-024',20240301,7,2,'completed',1,1799.00,179.90,1619.10,0,False),
    (25,'ORD-025',20240310,8,1,'completed',2,178.00,0,178.00,9.99,False),
    (26,'ORD-026',20240315,9,3,'completed',1,88.00,8.80,79.20,0,False),
    (27,'ORD-027',20240320,10,4,'completed',2,218.00,0,218.00,0,False),
    (28,'ORD-028',20240401,7,2,'completed',1,599.00,59.90,539.10,0,False),
    (29,'ORD-029',20240415,8,1,'completed',2,360.00,36.00,324.00,0,False),
    (30,'ORD-030',20240420,9,3,'refunded',1,150.00,0,150.00,0,False),
    (31,'ORD-031',20240501,7,4,'completed',1,139.00,13.90,125.10,0,False),
    (32,'ORD-032',20240515,8,1,'completed',2,397.00,0,397.00,0,False),
    (33,'ORD-033',20240301,13,2,'completed',1,349.00,34.90,314.10,9.99,True),
    (34,'ORD-034',20240305,14,1,'completed',2,356.00,0,356.00,9.99,True),
    (35,'ORD-035',20240310,15,3,'completed',1,999.00,99.90,899.10,0,True),
    (36,'ORD-036',20240315,16,2,'completed',3,537.00,53.70,483.30,9.99,True),
    (37,'ORD-037',20240320,17,6,'completed',1,88.00,0,88.00,3.99,True),
    (38,'ORD-038',20240325,18,4,'completed',2,198.00,19.80,178.20,0,True),
    (39,'ORD-039',20240401,13,2,'completed',1,799.00,79.90,719.10,0,False),
    (40,'ORD-040',20240410,14,1,'completed',2,298.00,0,298.00,9.99,False),
    (41,'ORD-041',20240415,15,3,'completed',1,140.00,14.00,126.00,0,False),
    (42,'ORD-042',20240420,16,2,'cancelled',2,698.00,0,698.00,0,False),
    (43,'ORD-043',20240501,13,4,'completed',1,109.00,0,109.00,0,False),
    (44,'ORD-044',20240510,14,1,'completed',1,140.00,14.00,126.00,0,False),
    (45,'ORD-045',20240515,15,3,'completed',2,330.00,33.00,297.00,9.99,False),
    (46,'ORD-046',20240401,19,1,'completed',1,1799.00,179.90,1619.10,0,True),
    (47,'ORD-047',20240405,20,3,'completed',2,239.00,0,239.00,9.99,True),
    (48,'ORD-048',20240410,21,2,'completed',1,349.00,34.90,314.10,9.99,True),
    (49,'ORD-049',20240415,22,6,'completed',3,267.00,26.70,240.30,9.99,True),
    (50,'ORD-050',20240420,23,2,'completed',2,690.00,69.00,621.00,0,True),
    (51,'ORD-051',20240425,24,1,'completed',1,99.00,0,99.00,5.99,True),
    (52,'ORD-052',20240501,19,4,'completed',1,599.00,59.90,539.10,0,False),
    (53,'ORD-053',20240510,20,3,'completed',2,178.00,0,178.00,9.99,False),
    (54,'ORD-054',20240515,21,2,'completed',1,799.00,79.90,719.10,0,False),
    (55,'ORD-055',20240520,22,6,'completed',2,306.00,0,306.00,9.99,False),
    (56,'ORD-056',20240601,19,4,'completed',1,139.00,13.90,125.10,0,False),
    (57,'ORD-057',20240610,20,3,'completed',2,240.00,24.00,216.00,0,False),
    (58,'ORD-058',20240501,25,4,'completed',1,89.00,0,89.00,3.99,True),
    (59,'ORD-059',20240505,26,1,'completed',2,280.00,28.00,252.00,9.99,True),
    (60,'ORD-060',20240510,27,3,'completed',1,150.00,15.00,135.00,5.99,True),
    (61,'ORD-061',20240515,28,2,'completed',3,417.00,0,417.00,9.99,True),
    (62,'ORD-062',20240520,29,6,'completed',1,18.00,0,18.00,3.99,True),
    (63,'ORD-063',20240525,30,1,'refunded',2,178.00,0,178.00,9.99,True),
    (64,'ORD-064',20240601,25,4,'completed',1,109.00,10.90,98.10,0,False),
    (65,'ORD-065',20240605,26,1,'completed',2,360.00,0,360.00,0,False),
    (66,'ORD-066',20240610,27,3,'completed',1,999.00,99.90,899.10,0,False),
    (67,'ORD-067',20240615,28,2,'completed',2,698.00,69.80,628.20,0,False),
    (68,'ORD-068',20240601,31,2,'completed',1,349.00,34.90,314.10,9.99,True),
    (69,'ORD-069',20240605,32,3,'completed',2,239.00,0,239.00,9.99,True),
    (70,'ORD-070',20240610,33,1,'completed',1,799.00,79.90,719.10,0,True),
    (71,'ORD-071',20240615,34,4,'completed',3,327.00,32.70,294.30,9.99,True),
    (72,'ORD-072',20240620,35,6,'completed',1,89.00,0,89.00,3.99,True),
    (73,'ORD-073',20240625,36,1,'completed',2,338.00,33.80,304.20,9.99,True),
]
# ---- end of fixed values ---------------------------------------------------

# ---- invented fixtures (ours, not reference data) --------------------------
# An extra product sharing a name with product 12, for name-merging in A13.
INVENTED_PRODUCT_ROWS = [
    (16, 'P016', 'Yoga Mat Pro', 'Sports', 'Yoga', 'Manduka', 42, 90, True),
]

# fact_order_items: item_key, order_id, product_key, quantity, unit_price, discount_pct,
#                   line_revenue, line_cost, line_margin
INVENTED_ITEM_ROWS = [
    (1, 'ORD-001', 2, 1, 349.00, 10, 314.10, 150.00, 164.10),
    (2, 'ORD-003', 5, 1, 89.00, 0, 89.00, 35.00, 54.00),    # three products:
    (3, 'ORD-003', 11, 1, 18.00, 0, 18.00, 8.00, 10.00),    # three pairs
    (4, 'ORD-003', 12, 1, 88.00, 0, 88.00, 40.00, 48.00),
    (5, 'ORD-008', 6, 1, 150.00, 0, 150.00, 75.00, 75.00),  # product 6 on two lines
    (6, 'ORD-008', 6, 1, 150.00, 0, 150.00, 75.00, 75.00),
    (7, 'ORD-008', 8, 1, 99.00, 0, 99.00, 60.00, 39.00),
    (8, 'ORD-010', 12, 1, 88.00, 0, 88.00, 40.00, 48.00),   # refunded order
    (9, 'ORD-007', 13, 1, 139.00, 0, 139.00, 80.00, 59.00), # 13 and 14 tie on revenue
    (10, 'ORD-016', 14, 1, 154.44, 10, 139.00, 50.00, 89.00),
    (11, 'ORD-004', 10, 1, 0.00, 0, 0.00, 45.00, -45.00),   # zero revenue category
    (12, 'ORD-013', 12, 2, 88.00, 5, 167.20, 80.00, 87.20), # same-named products
    (13, 'ORD-013', 16, 1, 90.00, 0, 90.00, 42.00, 48.00),
]

# fact_events: event_key, customer_key, session_id, event_type, event_ts
INVENTED_EVENT_ROWS = [
    (1, 1, 's1', 'pageview', '2024-03-01 10:00:00'),      # full funnel
    (2, 1, 's1', 'add_to_cart', '2024-03-01 10:01:00'),
    (3, 1, 's1', 'checkout', '2024-03-01 10:02:00'),
    (4, 1, 's1', 'purchase', '2024-03-01 10:03:00'),
    (5, 1, 's1', 'wishlist', '2024-03-01 10:04:00'),      # unknown type
    (6, 2, 's2', 'pageview', '2024-03-02 09:00:00'),      # drops after cart
    (7, 2, 's2', 'add_to_cart', '2024-03-02 09:05:00'),
    (8, 3, 's3', 'pageview', '2024-03-03 12:00:00'),      # drops after view
    (9, 4, 's4', 'pageview', '2024-03-04 08:00:00'),      # purchase without checkout
    (10, 4, 's4', 'add_to_cart', '2024-03-04 08:01:00'),
    (11, 4, 's4', 'purchase', '2024-03-04 08:02:00'),
    (12, 5, 's5', 'add_to_cart', '2024-03-05 07:00:00'),  # steps out of order
    (13, 5, 's5', 'pageview', '2024-03-05 07:01:00'),
    (14, 5, 's5', 'checkout', '2024-03-05 07:02:00'),
    (15, 6, 's6', 'pageview', '2024-03-06 18:00:00'),     # two sessions of customer 6
    (16, 6, 's6', 'add_to_cart', '2024-03-06 18:01:00'),
    (17, 6, 's6', 'checkout', '2024-03-06 18:02:00'),
    (18, 6, 's6', 'purchase', '2024-03-06 18:03:00'),
    (19, 6, 's7', 'pageview', '2024-03-07 18:00:00'),
]
# ---- end of invented fixtures ----------------------------------------------

_MONEY = T.DecimalType(18, 2)


def _date(s):
    return None if s is None else _dt.date.fromisoformat(s)


def _money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("week_of_year", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("day_name", T.StringType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
    T.StructField("is_holiday", T.BooleanType(), False),
])

DIM_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_key", T.LongType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("first_name", T.StringType(), False),
    T.StructField("last_name", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("age_band", T.StringType(), False),
    T.StructField("acquisition_channel", T.StringType(), False),
    T.StructField("effective_date", T.DateType(), False),
    T.StructField("expiry_date", T.DateType(), True),
    T.StructField("is_current", T.BooleanType(), False),
])

DIM_PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_key", T.LongType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("subcategory", T.StringType(), False),
    T.StructField("brand", T.StringType(), False),
    T.StructField("cost_price", _MONEY, False),
    T.StructField("list_price", _MONEY, False),
    T.StructField("is_active", T.BooleanType(), False),
])

DIM_CHANNEL_SCHEMA = T.StructType([
    T.StructField("channel_key", T.IntegerType(), False),
    T.StructField("channel_name", T.StringType(), False),
    T.StructField("channel_type", T.StringType(), False),
])

FACT_ORDERS_SCHEMA = T.StructType([
    T.StructField("order_key", T.LongType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("date_key", T.IntegerType(), True),
    T.StructField("customer_key", T.LongType(), True),
    T.StructField("channel_key", T.IntegerType(), True),
    T.StructField("order_status", T.StringType(), False),
    T.StructField("item_count", T.IntegerType(), False),
    T.StructField("gross_revenue", _MONEY, False),
    T.StructField("discount_amount", _MONEY, True),
    T.StructField("net_revenue", _MONEY, False),
    T.StructField("shipping_cost", _MONEY, True),
    T.StructField("is_first_order", T.BooleanType(), False),
])

FACT_ITEMS_SCHEMA = T.StructType([
    T.StructField("item_key", T.LongType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("product_key", T.LongType(), True),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", _MONEY, False),
    T.StructField("discount_pct", T.DecimalType(5, 2), True),
    T.StructField("line_revenue", _MONEY, False),
    T.StructField("line_cost", _MONEY, False),
    T.StructField("line_margin", _MONEY, False),
])

FACT_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_key", T.LongType(), False),
    T.StructField("customer_key", T.LongType(), True),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_ts", T.TimestampNTZType(), False),
])


def dim_date(spark: SparkSession) -> DataFrame:
    rows = [(r[0], _date(r[1]), *r[2:]) for r in DIM_DATE_ROWS]
    return spark.createDataFrame(rows, DIM_DATE_SCHEMA)


def dim_channel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIM_CHANNEL_ROWS, DIM_CHANNEL_SCHEMA)


def dim_customer(spark: SparkSession) -> DataFrame:
    rows = [(*r[:9], _date(r[9]), _date(r[10]), r[11]) for r in DIM_CUSTOMER_ROWS]
    return spark.createDataFrame(rows, DIM_CUSTOMER_SCHEMA)


def dim_product(spark: SparkSession, invented: bool = False) -> DataFrame:
    src = DIM_PRODUCT_ROWS + (INVENTED_PRODUCT_ROWS if invented else [])
    rows = [(*r[:6], _money(r[6]), _money(r[7]), r[8]) for r in src]
    return spark.createDataFrame(rows, DIM_PRODUCT_SCHEMA)


def fact_orders_raw(spark: SparkSession) -> DataFrame:
    """fact_orders as stored: date_key only, flag as loaded."""
    rows = [(*r[:7], _money(r[7]), _money(r[8]), _money(r[9]), _money(r[10]), r[11])
            for r in FACT_ORDER_ROWS]
    return spark.createDataFrame(rows, FACT_ORDERS_SCHEMA)


def fact_orders(spark: SparkSession) -> DataFrame:
    """fact_orders with ``order_date`` from the date dimension (star join)."""
    from tillsight.sources.model import attach_order_date
    return attach_order_date(fact_orders_raw(spark), dim_date(spark))


def invented_items(spark: SparkSession) -> DataFrame:
    rows = [(r[0], r[1], r[2], r[3], _money(r[4]), Decimal(r[5]).quantize(Decimal("0.01")),
             _money(r[6]), _money(r[7]), _money(r[8])) for r in INVENTED_ITEM_ROWS]
    return spark.createDataFrame(rows, FACT_ITEMS_SCHEMA)


def invented_events(spark: SparkSession) -> DataFrame:
    rows = [(*r[:4], _dt.datetime.fromisoformat(r[4])) for r in INVENTED_EVENT_ROWS]
    return spark.createDataFrame(rows, FACT_EVENTS_SCHEMA)
