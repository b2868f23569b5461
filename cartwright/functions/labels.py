"""Texts shown for segments. They must read as users of the data know them."""

# Fixed values: (main trait, description) of a behavior cluster.
OCCASIONAL = ("Ít đơn, ít mua", "Người dùng không thường xuyên")
LOYAL = ("Nhiều đơn, mua đều", "Người dùng trung thành")
CORE = ("Hoạt động ổn định", "Nhóm người dùng chủ lực")
ORDINARY = ("Mức trung bình", "Người dùng phổ thông")
POTENTIAL = ("Khá tích cực", "Người dùng tiềm năng")

# Text by behavior cluster id.
BEHAVIOR_TEXT = {
    0: "Người mua không thường xuyên",
    1: "Người mua ổn định",
    2: "Người mua nhiều",
    3: "Khách hàng tiềm năng",
    4: "Khách hàng VIP",
}

# Text by preference cluster id.
PREFERENCE_TEXT = {
    0: "Ưa chuộng hàng thiết yếu",
    1: "Ưa chuộng hàng khuyến mãi",
    2: "Ưa chuộng sản phẩm cao cấp",
    3: "Ưa chuộng hàng mới",
    4: "Ưa chuộng hàng đa dạng",
}

# Text by lifecycle stage.
LIFECYCLE_TEXT = {
    "new": "Khách hàng mới",
    "regular": "Khách thường xuyên",
    "active": "Khách hàng đang hoạt động",
    "loyal": "Khách hàng trung thành",
    "vip": "Khách VIP",
    "churn_risk": "Có nguy cơ rời bỏ",
}

UNKNOWN_TEXT = "Không xác định"
PRODUCT_PREFIX = "Sản phẩm #"

# Profile shown with the static fallback.
FALLBACK_BEHAVIOR_TEXT = "Chưa xác định"
FALLBACK_LIFECYCLE_TEXT = "Khách mới"
