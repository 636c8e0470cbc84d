"""Schemas of the three raw tables of a marketplace export, as DDL; all fields are nullable."""

from __future__ import annotations

# Column names and types of the export, in file order.
LISTINGS = """
    id bigint, listing_url string, scrape_id bigint, last_scraped date, source string,
    name string, description string, neighborhood_overview string, picture_url string,
    host_id bigint, host_url string, host_name string, host_since date,
    host_location string, host_about string, host_response_time string,
    host_response_rate string, host_acceptance_rate string, host_is_superhost string,
    host_thumbnail_url string, host_picture_url string, host_neighbourhood string,
    host_listings_count int, host_total_listings_count int, host_verifications string,
    host_has_profile_pic string, host_identity_verified string,
    neighbourhood string, neighbourhood_cleansed string,
    neighbourhood_group_cleansed string, latitude float, longitude float,
    property_type string, room_type string, accommodates int, bathrooms int,
    bathrooms_text string, bedrooms int, beds int, amenities string, price string,
    minimum_nights int, maximum_nights int, minimum_minimum_nights int,
    maximum_minimum_nights int, minimum_maximum_nights int, maximum_maximum_nights int,
    minimum_nights_avg_ntm int, maximum_nights_avg_ntm int, calendar_updated string,
    has_availability string, availability_30 int, availability_60 int,
    availability_90 int, availability_365 int, calendar_last_scraped date,
    number_of_reviews int, number_of_reviews_ltm int, number_of_reviews_l30d int,
    first_review date, last_review date, review_scores_rating float,
    review_scores_accuracy float, review_scores_cleanliness float,
    review_scores_checkin float, review_scores_communication float,
    review_scores_location float, review_scores_value float, license string,
    instant_bookable string, calculated_host_listings_count int,
    calculated_host_listings_count_entire_homes int,
    calculated_host_listings_count_private_rooms int,
    calculated_host_listings_count_shared_rooms int, reviews_per_month float
"""

CALENDAR = """
    listing_id bigint, date date, available string, price string, adjusted_price string,
    minimum_nights int, maximum_nights int
"""

REVIEWS = """
    listing_id bigint, id bigint, date date, reviewer_id bigint, reviewer_name string,
    comments string
"""
